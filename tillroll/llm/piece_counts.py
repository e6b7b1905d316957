"""Token counts of a sentencepiece BPE model without any token ids.

Two neighbouring characters that no vocabulary piece holds side by side are never
merged, so a text can be cut there: its count is the sum of its pre-tokens'
counts. (In this model the cut before a space is one such place, those around
line breaks, digits and most signs are others.) The pieces of a pre-token are
counted once for the whole corpus:

1. every task gives its pre-tokens with the number of documents that hold them,
   summed over the corpus: one row per distinct pre-token, whose pieces the
   library counts once. The table is stored.
2. the pre-tokens of the most documents, at most ``FREQUENT`` of them however large
   the corpus, have their counts broadcast (keys of at most 64 characters: a proven
   bound), and each document sums them where it lies.
3. the other (document, pre-token, frequency) rows are joined with the stored
   table by a shuffle and summed by document. As the frequent keys are gone,
   no key of that join holds more than 2 parts in ``FREQUENT`` of the rows.

Edge cases: null and empty texts have no tokens; a text of spaces counts as the
library has it; U+2581 is a space to this model; control characters, special
strings and characters without a piece count as the library has them; a text
without any cut is one pre-token and is keyed by its SHA-256; repeated rows stay
rows; null ids are kept; other columns are ignored; no rows: no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bpe import vocabulary_path
from tillroll.llm.common import frequent as most_frequent
from tillroll.llm.common import materialize, texts

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: at most so many pre-tokens are broadcast
FREQUENT = 200_000
#: longer pre-tokens are keyed by their digest
KEY_CHARS = 64
# entries a task sums up before it hands them on, code points cut at a time (memory only)
HELD_KEYS, BATCH_CHARS = 300_000, 500_000


class PieceModel:
    """A sentencepiece BPE model, the cuts that it never merges over, and counts."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path(MODEL))
        if "".join(self.sp.encode(" a  ﬁ ", out_type=str)) != f"{SPACE}{SPACE}a{SPACE}{SPACE}ﬁ{SPACE}":
            raise ValueError("the model rewrites its input: cuts of the text are not cuts of its tokens")
        sp = self.sp
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        pairs = {pair for i in plain for pair in zip(sp.id_to_piece(i), sp.id_to_piece(i)[1:])}
        signs = sorted({c for pair in pairs for c in pair})
        number = {c: i + 1 for i, c in enumerate(signs)}
        self.joins = np.zeros((len(signs) + 1, len(signs) + 1), bool)
        for a, b in pairs:
            self.joins[number[a], number[b]] = True
        self.number = np.zeros(0x110000, np.int16)
        for c, i in number.items():
            self.number[ord(c)] = i
        self.number[32] = number.get(SPACE, 0)
        # a sign that no piece joins with anything keeps the dummy space away from a pre-token
        self.fence = next(c for c in "\n\t\x01" if c not in number)
        self.fence_size = len(sp.encode(self.fence))

    def pre_tokens(self, batch: list[str]) -> list[list[str]]:
        """The pre-tokens of each text, in order, with the dummy space."""
        whole = [" " + t for t in batch if t]
        if not whole:
            return [[] for _ in batch]
        text = "".join(whole).replace(SPACE, " ")
        kind = self.number[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        edge = np.empty(len(kind), bool)
        np.logical_not(self.joins[kind[:-1], kind[1:]], out=edge[1:])
        sizes = np.fromiter(map(len, whole), np.int64, len(whole))
        begins = np.cumsum(sizes) - sizes
        edge[begins] = True
        at = np.flatnonzero(edge)
        ends = np.append(at[1:], len(kind)).tolist()
        parts = [text[a:b] for a, b in zip(at.tolist(), ends)]
        cut = np.append(np.searchsorted(at, begins), len(at)).tolist()
        rows = iter(zip(cut, cut[1:]))
        return [parts[slice(*next(rows))] if t else [] for t in batch]

    def counts(self, pre_tokens: list[str]) -> list[int]:
        """Pieces of each pre-token, as inside a text."""
        got = self.sp.encode([self.fence + p for p in pre_tokens], num_threads=1)
        return [len(ids) - self.fence_size for ids in got]


_MODELS: dict[str | None, PieceModel] = {}


def model(path: str | None = None) -> PieceModel:
    """The worker's model, made once per process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def key_of(pre_token: str) -> str:
    """The pre-token itself, or for a long one a line break and its digest (no
    pre-token but the line break alone holds one)."""
    if len(pre_token) <= KEY_CHARS:
        return pre_token
    return "\n" + hashlib.sha256(pre_token.encode("utf-8", "surrogatepass")).hexdigest()


def char_groups(column: pa.Array, limit: int = BATCH_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges of a text column of about ``limit`` code points, at least a row."""
    rows, begin, chars = column.to_pylist(), 0, 0
    for i, text in enumerate(rows):
        chars += len(text)
        if chars >= limit or i == len(rows) - 1:
            yield begin, i + 1, rows[begin:i + 1]
            begin, chars = i + 1, 0


def vocabulary(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Stored table of the corpus' distinct pre-tokens: ``key``, ``rows`` (the
    documents that hold it) and ``pieces`` (its tokens)."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            keys = [key_of(p) for p in held]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([p if p != k else None for p, k in zip(held, keys)], pa.string()),
                 pa.array(list(held.values()), pa.int64())], ["key", "whole", "rows"])
            held.clear()
            return batch

        for batch in batches:
            for _, _, group in char_groups(batch["text"]):
                for parts in model(path).pre_tokens(group):
                    held.update(set(parts))
                if len(held) > HELD_KEYS:
                    yield out()
        yield out()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [k if w is None else w for k, w in zip(batch["key"].to_pylist(), batch["whole"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["rows"], pa.array(model(path).counts(whole), pa.int64())], ["key", "rows", "pieces"])

    spread = texts(docs).select("text").mapInArrow(seen, "key string, whole string, rows long")
    distinct = spread.groupBy("key", "whole").agg(F.sum("rows").alias("rows"))
    return materialize(distinct.mapInArrow(counted, "key string, rows long, pieces long"), "pre-tokens")


def token_counts(docs: DataFrame, limit: int = 4096, path: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens)."""
    spark, known = docs.sparkSession, vocabulary(docs, path)
    often = most_frequent(known, "rows", frequent)
    common = spark.sparkContext.broadcast(dict(map(tuple, known.filter(often).select("key", "pieces").collect())))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, row = common.value.get, TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b, group in char_groups(batch["text"]):
                sums, keys, times, ends = [], [], [], [0]
                for parts in model(path).pre_tokens(group):
                    in_common = 0
                    for part, n in Counter(parts).items():
                        pieces = get(part if len(part) <= KEY_CHARS else key_of(part))
                        if pieces is None:
                            keys.append(key_of(part))
                            times.append(n)
                        else:
                            in_common += pieces * n
                    sums.append(in_common)
                    ends.append(len(keys))
                cut = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + b - a)), batch["doc_id"].slice(a, b - a), batch["n_bytes"].slice(a, b - a),
                     pa.array(sums, pa.int64()), pa.ListArray.from_arrays(cut, pa.array(keys, pa.string())),
                     pa.ListArray.from_arrays(cut, pa.array(times, pa.int64()))],
                    ["row", "doc_id", "n_bytes", "in_common", "keys", "times"])
                row += b - a

    sized = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    stored = materialize(sized.mapInArrow(
        summed, "row long, doc_id long, n_bytes long, in_common long, keys array<string>, times array<long>"), "pre-token-rows")
    rest = stored.select("row", F.explode(F.arrays_zip("keys", "times")).alias("at")).select("row", "at.keys", "at.times")
    rare = known.filter(~often).select(F.col("key").alias("keys"), "pieces")
    rest = rest.join(rare, "keys").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("in_rest"))
    n_tokens = F.col("in_common") + F.coalesce("in_rest", F.lit(0).cast("long"))
    return (stored.select("row", "doc_id", "n_bytes", "in_common").join(rest, "row", "left")
            .select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit")))
