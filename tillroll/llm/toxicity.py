"""Severity of toxic text by a cumulative-link (ordinal logistic) regression.

Grades: 0 for documents labelled clean; toxic ones get 1 .. ``grades - 1`` by how
dense the words are that mark them (quantiles of the toxic training documents).
Features are sparse: for each chosen word or word beginning ("abc*" stands for
all words that begin so; insults come in many forms) the logarithms of its count
and of its share of the words. One weight per feature, never negative, is shared
by all ordered thresholds: P(grade > j) = sigmoid(w x - t_j).
The result is the expected grade; a document is rejected from ``cut`` on, a
value of P(grade > 0) that the training folds choose.

The model is fitted on at most ``sample_rows`` labelled documents, those of the
smallest id hashes (the documented bound; equal texts count once); features are
chosen by the G statistic of their counts in it.
Scoring reads every word of every text.

Edge cases: null and empty texts have no features and the lowest severity, and
are kept; labels without a document and null labels are ignored; without labels
of both kinds the model has no words and nothing is rejected; repeated rows are
all scored; extra columns pass through ``reject_toxic`` untouched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, texts

SCORED = "doc_id long, severity double, p_toxic double, n_words long, n_marked long, rejected boolean"
#: lengths of the word beginnings that can be features
BEGINNINGS = (3, 4, 5, 6, 7)
_STRIP = ".,;:!?\"'()[]{}<>|*#$%&-_/\\`~@+="


@dataclass(frozen=True)
class SeverityModel:
    """Weights by word, ordered thresholds, rejection cut on P(grade > 0)."""

    words: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))
    thresholds: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    cut: float = 2.0

    def score(self, counts: Counter, n_words: int) -> tuple[float, float]:
        """Expected grade and P(grade > 0) of a text's feature counts."""
        at = [self.words[f] for f in counts]
        x = float((self.weights[:, at] * encoded(np.array(list(counts.values()), float), n_words)).sum())
        above = _sigmoid(x - self.thresholds)
        return float(above.sum()), float(above[0])


def encoded(counts: np.ndarray, n_words) -> np.ndarray:
    """Both logarithms of feature counts."""
    return np.stack([np.log1p(counts), np.log1p(100 * counts / np.maximum(1, n_words))])


def words_of(text: str) -> list[str]:
    """Lower-cased runs without white space, outer signs stripped."""
    return [w for x in text.lower().split() if (w := x.strip(_STRIP))]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_cumulative(x: np.ndarray, grade: np.ndarray, grades: int, l2: float = 0.5, rounds: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Weights (not negative) and ordered thresholds of a cumulative logit, by
    full-batch Adam on the mean log-likelihood; threshold gaps stay positive as
    exponentials."""
    n, d = x.shape
    params = np.zeros(d + grades - 1)  # weights, first threshold, log gaps
    m, v = np.zeros_like(params), np.zeros_like(params)
    rows = np.arange(n)
    for i in range(1, rounds + 1):
        w, t0, gap = params[:d], params[d], params[d + 1:]
        t = t0 + np.concatenate([[0.0], np.cumsum(np.exp(gap))])
        below = np.concatenate([np.zeros((n, 1)), _sigmoid(t[None, :] - (x @ w)[:, None]), np.ones((n, 1))], axis=1)
        hi, lo = below[rows, grade + 1], below[rows, grade]
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        dt = np.array([dhi[grade == j].sum() - dlo[grade == j + 1].sum() for j in range(grades - 1)])
        dgap = np.array([np.exp(gap[j]) * dt[j + 1:].sum() for j in range(grades - 2)])
        g = np.concatenate([x.T @ (dlo - dhi) - l2 * w, [dt.sum()], dgap]) / n
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params + 0.05 * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-9)
        params[:d] = np.maximum(params[:d], 0.0)
    return params[:d], params[d] + np.concatenate([[0.0], np.cumsum(np.exp(params[d + 1:]))])


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) >= k)]


def _counter(known: set[str]):
    """Counts of the known features in a list of words; most words are passed
    over by their first letters."""
    short = BEGINNINGS[0]
    heads = {f[:short] for f in known}  # a beginning has at least so many letters before its star

    def count(words: list[str]) -> Counter:
        return Counter(f for w in words if w[:short] in heads for f in features_of(w) if f in known)

    return count


def _sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(text, toxic) of the sampled labelled documents, stored."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    joined = texts(docs).join(F.broadcast(chosen), "doc_id")
    return materialize(joined.groupBy("text").agg(F.max("toxic").alias("toxic")), "labelled")


def _marks(sample: DataFrame, n1: int, n0: int, vocabulary: int, least_g: float) -> list[str]:
    """The features that mark toxic documents best, by G statistic; a longer
    beginning is left out where a chosen shorter one marks as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                found[toxic].update({f for w in set(words_of(text)) for f in features_of(w)})
            names = list(found[1])  # a feature of no toxic document marks nothing
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([found[1][f] for f in names], pa.int64())], ["feature", "in_toxic"])

    toxic = sample.filter("toxic = 1").mapInArrow(run, "feature string, in_toxic long").groupBy("feature").agg(
        F.sum("in_toxic").alias("k1")).filter("k1 >= 3")

    def run_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text in batch["text"].to_pylist():
                found.update({f for w in set(words_of(text)) for f in features_of(w)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["feature", "in_clean"])

    clean = sample.filter("toxic = 0").mapInArrow(run_clean, "feature string, in_clean long").groupBy("feature").agg(
        F.sum("in_clean").alias("k0"))
    k1, k0 = F.col("k1"), F.coalesce("k0", F.lit(0))
    share = n1 / (n1 + n0)
    g = 2 * (k1 * F.log(k1 / ((k1 + k0) * share)) + F.when(k0 > 0, k0 * F.log(k0 / ((k1 + k0) * (1 - share)))).otherwise(0.0))
    odds = (k1 + 0.5) / (k0 + 0.5)
    rows = (
        toxic.join(clean, "feature", "left")
        .select("feature", g.alias("g"), odds.alias("odds"), k1, k0.alias("k0"), (k1 / n1 > 2 * k0 / n0).alias("marks"))
        .filter(F.col("marks") & (F.col("g") >= least_g))
        .orderBy(F.desc("g"), F.desc(F.length("feature")), "feature").limit(8 * vocabulary).collect()
    )
    chosen: dict[str, tuple] = {}
    for r in rows:
        stem, counts = r["feature"].removesuffix("*"), (r["k1"], r["k0"], r["odds"])
        shorter = any(chosen.get(stem[:k] + "*", (0, 0, 0.0))[2] >= 0.5 * r["odds"] for k in range(1, len(stem) + 1))
        if not shorter and not any(c.startswith(stem) and chosen[c] == counts for c in chosen):
            chosen[r["feature"]] = counts
        if len(chosen) == vocabulary:
            break
    return list(chosen)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000, grades: int = 4, vocabulary: int = 256,
          least_g: float = 16.0) -> SeverityModel:
    """Fit the model on a bounded sample of labelled documents. Feature counts
    are made on the executors; ``8 * vocabulary`` features and the sample's few
    counts of the chosen ones come to the driver."""
    sample = _sample(docs, labels, sample_rows)
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    words = {f: i for i, f in enumerate(_marks(sample, n1, n0, vocabulary, least_g) if n1 and n0 else [])}
    if not words:
        return SeverityModel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(set(words))
        for batch in batches:
            found = [words_of(t) for t in batch["text"].to_pylist()]
            hits = [count(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"], pa.array([len(f) for f in found], pa.int64()),
                 pa.array([[words[f] for f in h] for h in hits], pa.list_(pa.int32())),
                 pa.array([list(h.values()) for h in hits], pa.list_(pa.int32()))],
                ["toxic", "n", "at", "counts"])

    rows = sample.select("toxic", "text").mapInArrow(run, "toxic int, n long, at array<int>, counts array<int>")
    rows = sorted(tuple(r) for r in rows.collect())
    x = np.zeros((2, len(rows), len(words)))
    marked = np.zeros(len(rows))
    for i, (_, n, at, counts) in enumerate(rows):
        x[:, i, at] = encoded(np.array(counts, float), n)
        marked[i] = sum(counts)
    x = np.concatenate(list(x), axis=1)
    toxic = np.array([r[0] for r in rows])
    n_words = np.array([r[1] for r in rows])
    density = marked / np.maximum(1, n_words)
    grade = np.zeros(len(rows), np.int64)
    cuts = np.quantile(density[toxic == 1], np.arange(1, grades - 1) / (grades - 1))
    grade[toxic == 1] = 1 + np.searchsorted(cuts, density[toxic == 1], side="right")
    # held-out P(grade > 0) of two folds chooses the cut with the best accuracy
    held = np.zeros(len(rows))
    for fold in (0, 1):
        train_on = np.arange(len(rows)) % 2 != fold
        w, t = fit_cumulative(x[train_on], grade[train_on], grades)
        held[~train_on] = _sigmoid(x[~train_on] @ w - t[0])
    options = np.unique(np.round(np.quantile(held, np.linspace(0, 1, 201)), 6))
    mids = (options[1:] + options[:-1]) / 2 if len(options) > 1 else np.array([0.5])
    right = [((held >= c) == (toxic == 1)).mean() for c in mids]
    cut = float(mids[int(np.flatnonzero(np.array(right) == max(right)).mean())])
    weights, thresholds = fit_cumulative(x, grade, grades)
    return SeverityModel(words, weights.reshape(2, -1), thresholds, cut)


def _scorer(model: SeverityModel):
    """Word count, marked words, expected grade and P(grade > 0) of a text."""
    count, blank = _counter(set(model.words)), model.score(Counter(), 1)

    def score(text: str) -> tuple[int, int, float, float]:
        words = words_of(text)
        hits = count(words)
        return (len(words), sum(hits.values()), *(model.score(hits, len(words)) if hits else blank))

    return score


def severities(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """``doc_id``, expected grade, P(grade > 0), word counts and decision of
    every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model)
        for batch in batches:
            n, marked, severity, p = zip(*map(score, batch["text"].to_pylist())) if batch.num_rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(severity, pa.float64()), pa.array(p, pa.float64()), pa.array(n, pa.int64()),
                 pa.array(marked, pa.int64()), pa.array([v >= model.cut for v in p], pa.bool_())],
                ["doc_id", "severity", "p_toxic", "n_words", "n_marked", "rejected"])

    return texts(docs).mapInArrow(run, SCORED)


def reject_toxic(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """The rows of ``docs``, columns as they are, that the model does not reject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model)
        for batch in batches:
            keep = [score(text or "")[3] < model.cut for text in batch["text"].to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
