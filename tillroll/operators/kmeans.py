"""K-Means as DataFrame aggregates, with the same result on every layout.

Spark ML's fit depends on how rows are partitioned (its seeding samples by
partition, its sums are of doubles). Here nothing does:

* scaled features are held in *fixed point* (whole millionths of a standard
  deviation), so the sums behind every mean are exact in any order. They fit a long
  for up to 9 * 10^12 rows: in standard deviations, absolute values average 1 at most;
* seeds are chosen by maximin: the row nearest to the mean first, then always the
  row farthest from all seeds so far, ties by CustomerID and Country;
* an iteration is one aggregate over (k, cluster), partial sums before the
  shuffle, for *all* values of k of a sweep at once: one scan per iteration. It
  stops when no centre moves, which exact sums make an exact test.

Distances to all centres of a sweep are array operations over Arrow batches: as
one expression they would be thousands of nodes that Spark compiles anew for every
step. A batch gives one row of sums per centre. What comes to the driver is one row
of sums per centre. Scoring with a fitted model is a plain expression.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import materialize

#: fixed-point units in one standard deviation
UNITS = 1_000_000


@dataclass(frozen=True)
class Centres:
    """A fitted model: what was scaled how, and the centres in fixed point."""

    features: list[str]
    mean: list[float]
    std: list[float]
    centres: list[list[float]]

    @property
    def k(self) -> int:
        return len(self.centres)


def scaling(prepared: DataFrame, features: Sequence[str]) -> tuple[list[float], list[float]]:
    """Mean and sample standard deviation of every feature (one aggregate)."""
    row = prepared.agg(*[f(F.col(c).cast("double")) for f in (F.avg, F.stddev_samp) for c in features]).first()
    n = len(features)
    return [v or 0.0 for v in row[:n]], [v or 0.0 for v in row[n:]]


def fixed_point(df: DataFrame, features: Sequence[str], mean: Sequence[float], std: Sequence[float]) -> DataFrame:
    """``df`` with ``x0``, ``x1``, ...: scaled features in whole units, halves up;
    0 for a feature without spread or value."""
    whole = [F.floor((F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) * UNITS + 0.5) if s else F.lit(0)
             for c, m, s in zip(features, mean, std)]
    return df.select("*", *[F.coalesce(w.cast("long"), F.lit(0).cast("long")).alias(f"x{i}") for i, w in enumerate(whole)])


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    """Feature rows (n x rows) of a batch; whole units are exact in a double."""
    return np.stack([batch[f"x{i}"].to_numpy().astype(float) for i in range(n)])


def _distances(x: np.ndarray, centres: Sequence[Sequence[float]]) -> np.ndarray:
    """Squared distances (rows x centres), features summed in their order."""
    out = np.empty((x.shape[1], len(centres)))
    for j, centre in enumerate(centres):
        d = (x[0] - centre[0]) * (x[0] - centre[0])
        for i in range(1, len(x)):
            d += (x[i] - centre[i]) * (x[i] - centre[i])
        out[:, j] = d
    return out


def maximin_seeds(points: DataFrame, n_features: int, k: int) -> list[list[float]]:
    """Seeds in the order they are chosen; the first j are the seeds of j clusters."""
    xs = [f"x{i}" for i in range(n_features)]
    order = ["CustomerID", "Country", *xs]
    seeds: list[list[float]] = []

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, n_features)
                near = _distances(x, seeds or [[0.0] * n_features]).min(axis=1)
                rank = -near if seeds else near
                at = np.flatnonzero(rank == rank.min())
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(rank[at]), *[rows[c] for c in order]], ["d", *order])

    shape = f"d double, {', '.join(f'{c} {dict(points.dtypes)[c]}' for c in order)}"
    while len(seeds) < k:
        best = points.select(*order).mapInArrow(candidates, shape).agg(F.min(F.struct("d", *order)).alias("r")).first().r
        if best is None:
            return []
        seeds.append([float(best[x]) for x in xs])
    return seeds


def lloyd(points: DataFrame, n_features: int, starts: dict[int, list[list[float]]], max_iter: int) -> dict[int, list[list[float]]]:
    """Move all models' centres to the means of their points, at most ``max_iter``
    times; a centre without points stays where it is."""
    xs = [f"x{i}" for i in range(n_features)]
    models, moving = dict(starts), dict(starts)

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, n_features)
            for k, centres in moving.items():
                j = _distances(x, centres).argmin(axis=1)  # the first of equal ones
                n = np.bincount(j, minlength=k)
                sums = [np.bincount(j, weights=v, minlength=k).astype(np.int64) for v in x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, k, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(n), *map(pa.array, sums)],
                    ["k", "j", "n", *xs])

    shape = f"k int, j int, n long, {', '.join(f'{x} long' for x in xs)}"
    for _ in range(max_iter):
        sums = (points.select(*xs).mapInArrow(partial_sums, shape).groupBy("k", "j")
                .agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in xs]).collect())  # k rows of each model
        moved = {k: list(cs) for k, cs in moving.items()}
        for r in sums:
            if r.n:
                moved[r.k][r.j] = [float(r[x]) / r.n for x in xs]
        models.update(moved)
        moving = {k: cs for k, cs in moved.items() if cs != moving[k]}
        if not moving:
            break
    return models


def quality(points: DataFrame, n_features: int, models: dict[int, list[list[float]]]) -> DataFrame:
    """One row per k: ``cost`` (squared distances to the nearest centre, in
    standard deviations) and ``silhouette`` (simplified: of the distances to
    the own and the next centre, their difference over the larger, averaged)."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, n_features)
            for k, centres in models.items():
                low = np.sort(_distances(x, centres), axis=1)
                own, other = np.sqrt(low[:, 0]), np.sqrt(low[:, min(1, k - 1)])
                width = np.divide(other - own, other, out=np.zeros_like(own), where=other > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([len(own)], pa.int64()), pa.array([low[:, 0].sum()]), pa.array([width.sum()])],
                    ["k", "n", "d", "s"])

    xs = [f"x{i}" for i in range(n_features)]
    return points.select(*xs).mapInArrow(rate, "k int, n long, d double, s double").groupBy("k").agg(
        (F.sum("d") / float(UNITS) ** 2).alias("cost"), F.try_divide(F.sum("s"), F.sum("n")).alias("silhouette"))


def with_choice(curve: DataFrame) -> DataFrame:
    """(k, cost, silhouette) with two recommendations: ``chord_gap`` is how far the
    cost lies below the straight line from the first k to the last, both axes
    scaled to 1; ``is_knee`` marks the largest gap, ``is_widest`` the largest
    silhouette, the smaller k of equal ones. The table has one row per k."""
    ends = curve.agg(
        F.min("k").alias("k0"), F.max("k").alias("k1"), F.max("cost").alias("c1"), F.min("cost").alias("c0"),
        F.min_by("cost", "k").alias("first"), F.max_by("cost", "k").alias("last"))
    x = F.coalesce(F.try_divide(F.col("k") - F.col("k0"), F.col("k1") - F.col("k0")), F.lit(0.0))
    line = F.col("first") + (F.col("last") - F.col("first")) * x
    gap = F.coalesce(F.try_divide(line - F.col("cost"), F.col("c1") - F.col("c0")), F.lit(0.0))
    rated = curve.crossJoin(F.broadcast(ends)).select("k", "cost", "silhouette", gap.alias("chord_gap"))
    best = rated.agg(F.min(F.struct(-F.round("chord_gap", 9), "k")).alias("g"), F.min(F.struct(-F.round("silhouette", 9), "k")).alias("s"))
    return rated.crossJoin(F.broadcast(best)).select(
        "k", "cost", "silhouette", "chord_gap", (F.col("k") == F.col("g.k")).alias("is_knee"),
        (F.col("k") == F.col("s.k")).alias("is_widest")).orderBy("k")


def points_of(prepared: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[float], list[float]]:
    """Stored fixed-point rows of ``prepared``, and how they were scaled."""
    mean, std = scaling(prepared, features)
    xs = [f"x{i}" for i in range(len(features))]
    points = fixed_point(prepared, features, mean, std).select("CustomerID", "Country", *xs)
    return materialize(points, "points"), mean, std


def sweep(prepared: DataFrame, features: Sequence[str], k_values: Sequence[int], max_iter: int) -> DataFrame:
    """Fit every k (one scan per iteration for all) and rate them. ``prepared``
    is read twice: store it."""
    points, _, _ = points_of(prepared, features)
    seeds = maximin_seeds(points, len(features), max(k_values))
    if not seeds:
        empty = points.sparkSession.createDataFrame([], "k int, cost double, silhouette double")
        return with_choice(empty)
    models = lloyd(points, len(features), {k: seeds[:k] for k in k_values}, max_iter)
    return with_choice(quality(points, len(features), models))


def fit(prepared: DataFrame, features: Sequence[str], k: int, max_iter: int) -> Centres:
    """Fit one k. ``prepared`` is read twice: store it."""
    points, mean, std = points_of(prepared, features)
    seeds = maximin_seeds(points, len(features), k) or [[0.0] * len(features)] * k
    return Centres(list(features), mean, std, lloyd(points, len(features), {k: seeds}, max_iter)[k])


def assign(prepared: DataFrame, model: Centres) -> DataFrame:
    """+ ``cluster_id`` of the nearest centre, the first of equal ones; rows are
    scaled as the model's were, so they need not be those of the fit."""
    scaled = fixed_point(prepared, model.features, model.mean, model.std)
    squares = [" + ".join(f"(x{i} - {v!r}D) * (x{i} - {v!r}D)" for i, v in enumerate(c)) for c in model.centres]
    near = scaled.withColumn("tr_d", F.expr(f"array({', '.join(squares)})"))
    return near.select(*prepared.columns, (F.array_position("tr_d", F.array_min("tr_d")) - 1).cast("int").alias("cluster_id"))


def save(model: Centres, spark: SparkSession, path: str) -> str:
    """The model as one JSON row at ``path`` (any store Spark writes)."""
    spark.createDataFrame([(json.dumps(asdict(model)),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load(spark: SparkSession, path: str) -> Centres:
    return Centres(**json.loads(spark.read.text(path).first().value))
