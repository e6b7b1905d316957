"""Vectors in tiles: exact integer top-k, and a forest of random projections.

Both searches take as queries the rows whose ``vec_id`` is divisible by a
number, and all rows as candidates. Rows without an id, and null, empty or
non-finite vectors (and, for cosines, zero ones) take no part; rows that repeat
a ``vec_id`` count once, with their smallest vector; vectors meet only vectors of
their own length; extra columns are ignored; no rows: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import groups_for, materialize, top_lists

_ITEM = "array<struct<down:{kind},vec_id:long>>"


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec as doubles, dim) of the rows that take part."""
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
        .select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"), F.size("embedding").alias("dim"))
        .filter(finite.isNotNull() & finite)
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.empty((0, 0))


def _one_per_id(pdf: pd.DataFrame) -> pd.DataFrame:
    """The smallest vector of each id."""
    if not pdf["vec_id"].duplicated().any():
        return pdf
    order = sorted(range(len(pdf)), key=lambda i: (pdf["vec_id"].iloc[i], tuple(pdf["vec"].iloc[i])))
    return pdf.iloc[order].drop_duplicates("vec_id")


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[list, list]:
    """The k largest scores (ties: smaller id) among rows other than ``own``."""
    if len(scores) > k + 1:
        least = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    at = at[ids[at] != own]
    at = at[np.lexsort((ids[at], -scores[at]))[:k]]
    return scores[at].tolist(), ids[at].tolist()


def _ranked(lists: DataFrame, score: str) -> DataFrame:
    out = lists.select("query_id", F.posexplode("best").alias("_at", "_x"))
    return out.select("query_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_x.vec_id").alias("vec_id"),
                      (-F.col("_x.down")).alias(score))


# ------------------------------------------------------------ exact products

def _whole(vec: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vec * scale)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of whole-numbered doubles: by floating products
    where every partial sum is below 2^53, else in Python integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    exact = lambda m: np.array([[int(x) for x in row] for row in m], object)
    return exact(a).dot(exact(b).T)


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, query_rows: int = 2048,
                tile_rows: int = 8192) -> DataFrame:
    """Each query's ``k`` largest integer inner products of floor(scale * x).

    Rows are dealt into tiles of about ``tile_rows``, queries into blocks of
    about ``query_rows`` (by hash of the id, which grows the numbers of tiles and
    blocks, never their size). Each pair of block and tile is one matrix product;
    its partial selection leaves k items per query, and a tree of merges joins
    the tiles' lists. Scores outside 64 bits are refused."""
    rows = materialize(valid(vectors), "vectors")
    tiles = groups_for(rows.count(), tile_rows)
    is_query = F.col("vec_id") % every == 0
    blocks = groups_for(rows.filter(is_query).count(), query_rows)
    tile = F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    candidates = rows.withColumn("tile", tile).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = rows.filter(is_query).select(
        F.col("vec_id").alias("query_id"), F.col("vec").alias("asked"), F.col("dim").alias("dim_q"), "vec_id").withColumn("block", block).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).drop("vec_id")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            left, right = _one_per_id(left.rename(columns={"query_id": "vec_id", "asked": "vec"})), _one_per_id(right)
            ids, m = right["vec_id"].to_numpy(), _whole(_matrix(right["vec"]), scale)
            q = _whole(_matrix(left["vec"]), scale)
            for at in range(0, len(q), 256):
                scores = _products(q[at:at + 256], m)
                for query, row in zip(left["vec_id"].iloc[at:at + 256].tolist(), scores):
                    down, found = _best(row, ids, query, k)
                    if found:
                        out.append((query, int(left["tile"].iloc[0]),
                                    [{"down": -int(s), "vec_id": v} for s, v in zip(down, found)]))
        return pd.DataFrame(out, columns=["query_id", "tile", "best"])

    lists = queries.groupBy("tile", "block", "dim_q").cogroup(candidates.groupBy("tile", "block", "dim")).applyInPandas(
        run, f"query_id long, tile int, best {_ITEM.format(kind='long')}")
    return _ranked(top_lists(lists, "query_id", "tile", "best", k, tiles), "score")


# -------------------------------------------------- forest of random projections

class Forest:
    """Trees of random hyperplanes over a bounded sample of vectors. A node
    parts its sample at the median of its projections on the difference of two
    sampled points; a leaf holds at most ``leaf`` sampled rows."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.normals: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.kids: list[tuple[int, int]] = []   # >= 0: node, < 0: -1 - leaf
        self.leaf_rows: list[int] = []
        self.leaf_tree: list[int] = []
        self.roots = [self._grow(sample, np.arange(len(sample)), leaf, t, rng) for t in range(trees)]

    def _leaf(self, rows: int, tree: int) -> int:
        self.leaf_rows.append(rows)
        self.leaf_tree.append(tree)
        return -len(self.leaf_rows)

    def _grow(self, sample, rows, leaf, tree, rng) -> int:
        if len(rows) <= leaf:
            return self._leaf(len(rows), tree)
        for _ in range(8):
            a, b = rng.choice(rows, 2, replace=False)
            normal = sample[a] - sample[b]
            size = np.linalg.norm(normal)
            if size == 0:
                continue
            side = sample[rows] @ (normal / size)
            cut = float(np.median(side))
            right = side > cut
            if right.any() and not right.all():
                break
        else:
            return self._leaf(len(rows), tree)  # equal points: one leaf, whatever its size
        node = len(self.normals)
        self.normals.append(normal / size)
        self.cuts.append(cut)
        self.kids.append((0, 0))
        self.kids[node] = (self._grow(sample, rows[~right], leaf, tree, rng), self._grow(sample, rows[right], leaf, tree, rng))
        return node

    def leaf_of(self, unit: np.ndarray, tree: int) -> np.ndarray:
        """The leaf of each row in one tree."""
        out = np.empty(len(unit), np.int64)
        stack = [(self.roots[tree], np.arange(len(unit)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                out[rows] = -1 - node
                continue
            right = unit[rows] @ self.normals[node] > self.cuts[node]
            for kid, part in zip(self.kids[node], (rows[~right], rows[right])):
                if len(part):
                    stack.append((kid, part))
        return out

    def visits(self, unit: np.ndarray, share: float, total: int, reach: float = math.inf) -> list[int]:
        """Leaves to search for one query: one priority queue over all trees,
        by the largest margin on the way, until the leaves visited hold
        ``share`` of the sample or the next margin is beyond ``reach``: a unit
        vector across a plane is at least the margin away."""
        import heapq

        queue = [(-math.inf, root) for root in self.roots]
        heapq.heapify(queue)
        found, held = [], 0
        while queue and held < share * total:
            margin, node = heapq.heappop(queue)
            if margin > reach:
                break
            while node >= 0:
                d = float(unit @ self.normals[node]) - self.cuts[node]
                left, right = self.kids[node]
                near, far = (right, left) if d > 0 else (left, right)
                heapq.heappush(queue, (max(margin, abs(d)), far))
                node = near
            found.append(-1 - node)
            held += self.leaf_rows[-1 - node]
        return found


def forest_top_k(vectors: DataFrame, k: int = 5, every: int = 50, trees: int = 8, leaf: int = 64, sample_rows: int = 20_000,
                 search_share: float = 1.3, block_rows: int = 2048, first_trees: int = 2) -> DataFrame:
    """Each query's ``k`` nearest rows by cosine among the leaves it visits.

    The hyperplanes come from ``sample_rows`` rows, those of the smallest id
    hashes (a bounded, documented sample); every row is indexed. Rows stand once
    under the leaves of all trees: (tree, leaf, block) with leaves of more than
    ``block_rows`` rows in several blocks, so a hot leaf is searched in parts.

    A query first searches its own leaves of ``first_trees`` trees. The k-th cosine
    found there says how far away a better row can be, and the queue over all
    trees stops at the first margin beyond that: what it leaves out cannot be
    among the ``k`` nearest. Where rows have clusters this ends the search early;
    where they have none, the sum of the visited leaves' shares reaches
    ``search_share``, which bounds it. A block and its queries are one matrix
    product; what comes within rounding of a query's k best is reranked by its
    exact cosine. A row found in several trees counts once."""
    rows = materialize(
        valid(vectors).filter(F.exists("vec", lambda x: x != 0)).groupBy("vec_id", "dim").agg(F.min("vec").alias("vec")), "vectors")
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vec", "dim").toPandas()
    forests = {}
    for dim, part in picked.groupby("dim"):
        unit = _unit(_matrix(part["vec"]))
        forests[int(dim)] = (Forest(unit, trees, leaf), len(unit))
    # a length that the sample lacks is searched whole, as one leaf
    shared = rows.sparkSession.sparkContext.broadcast(forests)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            for dim, part in pdf.groupby("dim"):
                unit = _unit(_matrix(part["vec"]))
                forest = shared.value.get(int(dim))
                ids = pa.array(part["vec_id"].to_numpy())
                for t in range(trees if forest else 1):
                    at = forest[0].leaf_of(unit, t) if forest else np.zeros(len(unit), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([dim] * len(part), pa.int32()), pa.array([t] * len(part), pa.int32()), pa.array(at)],
                        ["vec_id", "dim", "tree", "leaf"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            for dim, part in pdf.groupby("dim"):
                forest = shared.value.get(int(dim))
                if not forest:
                    continue
                unit = _unit(_matrix(part["vec"]))
                home = [forest[0].leaf_of(unit, t) for t in range(min(first_trees, trees))]
                ids, leaves = [], []
                for i, (vec_id, u, kth) in enumerate(zip(part["vec_id"].tolist(), unit, part["kth"].tolist())):
                    reach = math.sqrt(max(0.0, 2 - 2 * kth) + 1e-12) if kth == kth else math.inf
                    seen = {int(h[i]) for h in home}
                    to = [x for x in forest[0].visits(u, search_share, forest[1], reach) if x not in seen]
                    ids += [vec_id] * len(to)
                    leaves += to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([dim] * len(ids), pa.int32()), pa.array(leaves, pa.int64())],
                    ["query_id", "dim", "leaf"])

    query_rows = rows.filter(F.col("vec_id") % every == 0)
    placed = materialize(rows.mapInArrow(index, "vec_id long, dim int, tree int, leaf long"), "leaves")
    leaves = max([1, *(len(f.leaf_rows) for f, _ in forests.values())])
    home = materialize(placed.filter((F.col("vec_id") % every == 0) & (F.col("tree") < first_trees)).select(
        F.col("vec_id").alias("query_id"), "dim", "leaf"), "home")
    first = materialize(top_lists(_leaf_lists(rows, query_rows, placed.filter(F.col("tree") < first_trees), home, k, block_rows),
                                  "query_id", "part", "best", k, leaves), "first-lists")
    kth = first.select(F.col("query_id").alias("vec_id"),
                       F.when(F.size("best") >= k, -F.get("best", F.lit(k - 1))["down"]).alias("kth"))
    asked = query_rows.join(kth, "vec_id", "left").select("vec_id", "dim", "vec", "kth")
    visits = materialize(asked.mapInArrow(probe, "query_id long, dim int, leaf long"), "visits")
    lists = _leaf_lists(rows, query_rows, placed, visits, k, block_rows).unionByName(first.withColumn("part", F.lit(0)))
    return _ranked(top_lists(lists, "query_id", "part", "best", k, leaves), "score")


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def cosines(m: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``m`` with ``x``, or with the row of ``x`` beside it;
    every row is summed the same way, so equal vectors get equal scores."""
    return (m * x).sum(axis=1) / (np.sqrt((m * m).sum(axis=1)) * np.sqrt((x * x).sum(axis=-1)))


#: more than two ways of summing a cosine can differ by
_ROUNDING = 1e-9


def _near(asked: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) places of the unit vectors ``asked`` and ``rows`` whose cosine
    may be among the query's k + 1 largest: by matrix products, with room for
    rounding."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for at in range(0, len(asked), 256):
        scores = asked[at:at + 256] @ rows.T
        n = scores.shape[1]
        low = np.partition(scores, n - k - 1, axis=1)[:, n - k - 1, None] - _ROUNDING if n > k + 1 else -np.inf
        query, row = np.nonzero(scores >= low)
        found.append((query + at, row))
    query, row = zip(*found)
    return np.concatenate(query), np.concatenate(row)


def _best_pairs(asked: np.ndarray, asked_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """Places in ``asked``, row ids and cosines of each query's k nearest rows
    other than its own, by query and nearness (ties: smaller id)."""
    query, row = _near(_unit(asked), _unit(rows), k)
    other = ids[row] != asked_ids[query]
    query, row = query[other], row[other]
    score = np.concatenate([np.empty(0)] + [
        cosines(rows[row[at:at + 65_536]], asked[query[at:at + 65_536]]) for at in range(0, len(row), 65_536)])
    order = np.lexsort((ids[row], -score, query))
    query, row, score = query[order], row[order], score[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], ids[row[place < k]], score[place < k]


def _leaf_lists(rows: DataFrame, query_rows: DataFrame, placed: DataFrame, visits: DataFrame, k: int, block_rows: int) -> DataFrame:
    """``best``, the k nearest rows of each query in each block of the leaves it
    visits; ``part`` is the leaf. Leaves that no query visits move no vectors."""
    key = ["dim", "leaf"]
    wanted = placed.join(visits.select(*key).distinct(), key, "left_semi")
    sizes = wanted.groupBy(*key).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    spread = (
        wanted.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
        .select("vec_id", *key, "block").join(rows, ["vec_id", "dim"])
    )
    asked = (
        visits.join(sizes, key).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).drop("blocks")
        .join(query_rows.select(F.col("vec_id").alias("query_id"), "dim", F.col("vec").alias("asked")), ["query_id", "dim"])
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "part", "best"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), lists)], names=names)
        asked_ids = left["query_id"].to_numpy()
        query, found, score = _best_pairs(_rows_of(left["asked"]), asked_ids, _rows_of(right["vec"]), right["vec_id"].to_numpy(), k)
        some, first = np.unique(query, return_index=True)
        items = pa.StructArray.from_arrays([pa.array(-score), pa.array(found)], fields=list(lists.value_type))
        best = pa.ListArray.from_arrays(pa.array(np.append(first, len(query)), pa.int32()), items)
        return pa.table([pa.array(asked_ids[some]), pa.array([left["leaf"][0].as_py()] * len(some), pa.int32()), best.cast(lists)], names=names)

    lists = pa.list_(pa.struct([("down", pa.float64()), ("vec_id", pa.int64())]))
    on = [*key, "block"]
    # blocks and lengths of a leaf number meet in the first merge
    return asked.groupBy(*on).cogroup(spread.groupBy(*on)).applyInArrow(
        run, f"query_id long, part int, best {_ITEM.format(kind='double')}")


def _rows_of(column: pa.ChunkedArray) -> np.ndarray:
    """The matrix of a column of vectors of one length."""
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks])
    return flat.reshape(len(column), -1)
