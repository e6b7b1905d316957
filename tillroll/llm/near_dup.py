"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. Each document becomes its set of word shingles (64-bit hashes) and a
   signature of ``hashes`` minima. Documents with equal sets are one from here
   on (the class keeps its smallest ``doc_id``).
2. The forest: ``trees`` sorted orders, tree t reading the signature from
   position ``t * step`` on. One range exchange sorts all trees; a hot region is
   split like any other. Neighbours in an order are candidates if their common
   prefix has ``min_depth`` values, and one more for every fourfold of the places
   between them (up to ``window``): a sparse region is searched at
   ``min_depth``, a crowded one deeper, and candidates stay in proportion to the
   documents. The next ``sketch`` values of the signature travel with a row and
   must agree about as often as linked texts' do.
3. Candidates are confirmed on their full shingle sets.
4. Links join classes to components; a document is kept if it is the smallest
   of its component.
5. Rows of a run of equal ``min_depth`` prefixes that is longer than the window
   (a crowd) may have links that the window does not reach. They are joined
   exactly on the rarest shingles of their sets (two sets at the threshold share
   one of them; so the window only offers next neighbours there), leaving out pairs inside one component: first each row with the
   most typical row of a shingle, then, over what is still apart, all rows.

A lone pair at the threshold is a candidate in a tree with odds of about 0.6, in
none of 32 trees about once in 10^12; links between rows of crowds are searched
exactly.

Edge cases: null and empty texts have an empty set and no link; classes whose
smallest ids are equal (repeated ids with different texts) count as one node; a
row with a null id takes its class's component (null if the class has no id) and
is not kept; extra columns are ignored; no rows: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, texts
from tillroll.llm.components import components

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SETS = "doc_id long, n_shingles long, digest binary, signature binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(batch: list[str], width: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes. Words are runs of
    bytes other than ASCII white space, A-Z lowered; a text of fewer than
    ``width`` words is one shingle, a text of none has none."""
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in batch]
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return [np.empty(0, np.uint64) for _ in batch]
    # word hash: bytes weighted by powers of an odd number, counted from the word's end
    length = ends - starts
    longest = int(length.max())
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, np.uint64(0x5851F42D4C957F2D))]))
    spread = _mix(np.arange(256, dtype=np.uint64) + np.uint64(1))
    place = np.repeat(ends, length) - 1 - (np.arange(int(length.sum())) + np.repeat(starts - (np.cumsum(length) - length), length))
    value = spread[data[~blank]] * powers[place]
    word = _mix(np.add.reduceat(value, np.cumsum(length) - length) + length.astype(np.uint64))
    first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    out = []
    n = len(word)
    whole = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        whole = (whole + word[k:n - width + 1 + k]) * _ODD if n >= width else whole
    whole = _mix(whole) if n >= width else whole
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(whole[a:b - width + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for w in word[a:b]:
                h = _mix(np.array([h + w], np.uint64) * _ODD)[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest of the products with each factor, upper 32 bits."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        part = shingles[at:at + 512]
        np.minimum(low, (part[None, :] * factors[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def factors(hashes: int) -> np.ndarray:
    return _mix(np.arange(1, hashes + 1, dtype=np.uint64) * _ODD) | np.uint64(1)


def signatures(docs: DataFrame, width: int = 5, hashes: int = 128) -> DataFrame:
    """``doc_id``, set size, set digest and signature (big-endian) of each text."""
    by = factors(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    rows = batch.slice(at, 512)
                    sets = shingle_sets(rows["text"].to_pylist(), width)
                    yield pa.RecordBatch.from_arrays([
                        rows["doc_id"],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([signature(s, by).astype(">u4").tobytes() if len(s) else None for s in sets], pa.binary()),
                    ], ["doc_id", "n_shingles", "digest", "signature"])

    return texts(docs).mapInArrow(run, _SETS)


def candidates(classes: DataFrame, hashes: int, trees: int, depth: int, sketch: int, min_depth: int, window: int,
               least: float) -> DataFrame:
    """Neighbours (a, b) in the forest's orders over (id, signature) that agree
    in a share of at least ``least`` of the ``sketch`` values after the prefix
    (a byte of each is compared); and (a, a) of each row whose run of equal
    ``min_depth`` prefixes reaches beyond the window."""
    step = hashes // trees

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = np.frombuffer(b"".join(batch["signature"].to_pylist()), ">u4").reshape(n, hashes)
            for t in range(trees):
                turned = np.roll(values, -step * t, axis=1)
                prefix = np.ascontiguousarray(turned[:, :depth])
                low = (turned[:, depth:depth + sketch] & 0xFF).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch["id"], pa.array([t] * n, pa.int32()), pa.array([r.tobytes() for r in prefix], pa.binary()),
                     pa.array([r.tobytes() for r in low], pa.binary())], ["id", "tree", "prefix", "sketch"])

    orders = classes.select("id", "signature").mapInArrow(spread, "id long, tree int, prefix binary, sketch binary")
    keys = ["tree", "prefix", "id"]
    ordered = orders.repartitionByRange(*keys).sortWithinPartitions(*keys)
    deepest = min(depth, min_depth + (window - 1).bit_length() // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, near, low = np.empty(0, np.int64), np.empty((0, deepest + 1), np.uint32), np.empty((0, sketch), np.uint8)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            prefix = np.frombuffer(b"".join(batch["prefix"].to_pylist()), ">u4").reshape(n, depth)[:, :deepest]
            tree = batch["tree"].to_numpy().astype(np.uint32)[:, None]
            old = len(ids)
            ids = np.concatenate([ids, batch["id"].to_numpy()])
            near = np.concatenate([near, np.hstack([tree, prefix.astype(np.uint32)])])
            low = np.concatenate([low, np.frombuffer(b"".join(batch["sketch"].to_pylist()), np.uint8).reshape(n, sketch)])
            a, b = [], []
            far = np.flatnonzero((near[window:, :1 + min_depth] == near[:-window, :1 + min_depth]).all(axis=1)) if len(ids) > window else np.empty(0, np.int64)
            crowded = np.zeros(len(ids), bool)
            for end in (far, far + window):
                crowded[end] = True
                a.append(ids[end]), b.append(ids[end])
            for o in range(1, window + 1):
                lo = max(0, old - o)
                level = 1 + min(deepest, min_depth + (o - 1).bit_length() // 2)
                same = np.flatnonzero((near[lo + o:, :level] == near[lo:len(ids) - o, :level]).all(axis=1)) + lo
                if o > 2:  # two rows of crowds are joined exactly later
                    same = same[~(crowded[same] & crowded[same + o])]
                same = same[(low[same] == low[same + o]).mean(axis=1) >= least]
                a.append(ids[same]), b.append(ids[same + o])
            a, b = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])
            ids, near, low = ids[-window:], near[-window:], low[-window:]

    return ordered.mapInArrow(run, "a long, b long").distinct()


def full_sets(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``doc_id`` and full shingle set of the texts in ``pairs``, stored."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    rows = batch.slice(at, 512)
                    yield pa.RecordBatch.from_arrays(
                        [rows["doc_id"], pa.array([s.tobytes() for s in shingle_sets(rows["text"].to_pylist(), width)], pa.binary())],
                        ["doc_id", "shingles"])

    ends = [pairs.select(F.col(c).alias("doc_id")).distinct() for c in ("a", "b")]
    ids = ends[0].unionByName(ends[1]).distinct()
    return materialize(texts(docs).join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(sets, "doc_id long, shingles binary"), "sets")


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``doc_id`` whose full sets share at least ``percent`` of their
    union, with the two set sizes' intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, shared = [], []
            for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                i = int((both[1:] == both[:-1]).sum())
                good.append(100 * i >= percent * (len(both) - i))
                shared.append(i)
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch["a"].filter(keep), batch["b"].filter(keep), pa.array(shared, pa.int64()).filter(keep)], ["a", "b", "shared"])

    return (
        pairs.join(full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
        .join(full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
        .select("a", "b", "x", "y").mapInArrow(run, "a long, b long, shared long")
    )


def _rarity(sets: DataFrame) -> np.ndarray:
    """How often shingles of each of 2^16 hash buckets occur: orders shingles
    from rare to common (any one order keeps the join exact)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for s in batch["shingles"].to_pylist():
                seen += np.bincount((np.frombuffer(s, np.uint64) >> np.uint64(48)).astype(np.int64), minlength=1 << 16)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "n"])

    often = np.zeros(1 << 16, np.int64)
    counted = sets.select("shingles").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in counted.collect():  # at most 2^16 rows
        often[bucket] = n
    return often


def _rare_shingles(sets: DataFrame, labels: DataFrame, often: np.ndarray, percent: int) -> DataFrame:
    """For each set (id) its component and its rarest shingles, so many that two
    linked sets share one; ``place`` in the set's order from rare to common, set
    size ``n``, and how common the set's shingles are on average (``typical``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                found, size, mean = [], [], []
                for raw in rows["shingles"].to_pylist():
                    s = np.frombuffer(raw, np.uint64)
                    f = often[(s >> np.uint64(48)).astype(np.int64)]
                    found.append(s[np.lexsort((s, f))[:len(s) - (percent * len(s) + 99) // 100 + 1]])
                    size.append(len(s)), mean.append(f.mean())
                k = [len(f) for f in found]
                if not k:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)),
                     pa.array(np.repeat(rows["id"].to_numpy(), k)), pa.array(np.repeat(rows["component"].to_numpy(), k)),
                     pa.array(np.concatenate([np.arange(i, dtype=np.int64) for i in k])), pa.array(np.repeat(np.array(size, np.int64), k)),
                     pa.array(np.repeat(np.array(mean, float), k))],
                    ["shingle", "id", "component", "place", "n", "typical"])

    label = labels.select(F.col("node").alias("id"), "component")
    placed = sets.join(label, "id", "left").select("id", F.coalesce("component", "id").alias("component"), "shingles")
    return materialize(
        placed.mapInArrow(run, "shingle long, id long, component long, place long, n long, typical double"), "rare-shingles")


def crowd_links(crowd: DataFrame, full: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """``links`` (a, b) and those that join all linked sets of the ids in
    ``crowd`` to its components."""
    sets = materialize(full.withColumnRenamed("doc_id", "id").join(crowd, "id", "left_semi"), "crowd")
    often = _rarity(sets)
    for every in (False, True):
        rare = _rare_shingles(sets, components(links), often, percent)
        mixed = rare.groupBy("shingle").agg(
            F.min("component").alias("_lo"), F.max("component").alias("_hi"),
            F.max(F.struct("typical", "id", "component")).alias("top"),
        ).filter("_lo <> _hi").select(F.col("shingle").alias("_s"), F.col("top.id").alias("other"), F.col("top.component").alias("_main"))
        # rows outside the component of the shingle's most typical row
        apart = rare.join(mixed, (F.col("shingle") == F.col("_s")) & (F.col("component") != F.col("_main")))
        if every:
            x, y = apart.drop("other").alias("x"), rare.alias("y")
            shared = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))  # at most, from their first one on
            apart = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component"))
                           & (shared * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent)
                           ).select(F.col("x.id").alias("id"), F.col("y.id").alias("other"))
        pairs = apart.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
        found = confirmed(materialize(pairs, "crowd-pairs"), full, percent).select("a", "b")
        links = materialize(links.unionByName(found), "crowd-links")
    return links


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, hashes: int = 160, trees: int = 32,
                    depth: int = 7, sketch: int = 48, min_depth: int = 3, window: int = 16) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``
    and ``kept``. Texts are linked when their shingle sets share ``percent`` of
    their union."""
    seen = materialize(signatures(docs, width, hashes), "signatures")
    classes = materialize(
        seen.filter("n_shingles > 0").groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature")),
        "classes")
    nodes = classes.filter("id IS NOT NULL")
    pairs = materialize(
        candidates(nodes, hashes, trees, depth, sketch, min_depth, window, percent / 100 - 0.15), "candidates")
    full = full_sets(pairs, docs, width)
    links = materialize(confirmed(pairs.filter("a <> b"), full, percent).select("a", "b"), "confirmed")
    crowd = pairs.filter("a = b").select(F.col("a").alias("id"))
    if crowd.limit(1).count():
        links = crowd_links(crowd, full, links, percent)
    labels = components(links)
    label = labels.select(F.col("node").alias("id"), "component")
    of_class = classes.select("digest", "id").join(label, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("_component"))
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    return (
        seen.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"),
                F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
    )
