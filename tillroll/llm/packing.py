"""Packing of documents into sequences of a fixed length, with certificates.

Documents are encoded and cut where they lie; only piece sizes travel. Pieces of
full length are sequences already. The others are dealt into groups of about
``group_pieces`` by a hash of document, number and ids, so the result does not depend
on how the documents are partitioned. Each group is packed best-fit decreasing and
gets a lower bound from dual-feasible functions. A group whose sequences equal its
bound is certified; one with a gap fills its open sequences anew by exact sums.

The bound over the histogram of all sizes (at most ``capacity`` rows) certifies the
whole. While the sum of sequences is above it, documents are exchanged: a group hands
over sequences in proportion to its gap, or to the groups' share of what the whole is
above its bound, the emptiest and those of the smallest pieces, which fill the
others' rooms. What is handed over is dealt into new groups and packed again; the
proportion doubles from round to round. A round that gains nothing is taken back, and
the next one deals groups of twice the size, up to ``largest_group`` (what one
task packs at most). Two such rounds in a row at that size end the exchange.

Edge cases: null texts are empty and hold the end id alone; repeated rows are all
packed; other columns are ignored; no rows: no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bpe import encoder
from tillroll.llm.common import groups_for, materialize, texts
from tillroll.llm.token_files import list_array

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, unit long"
_PACKED = ("unit long, key long, length long, home long, bin long, offset long, fill long, empty_rank long, small_rank long, "
           "bins long, bound long, level int")


def pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """Documents' ids plus ``end_id``, cut into pieces: all of ``capacity`` but
    the first, which holds the rest. ``unit`` numbers the pieces (unique in one
    evaluation: store before using twice); ``with_ids`` adds the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, unit = encoder(vocabulary), TaskContext.get().partitionId() << 40
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                doc, number, start, size, crc, ids = [], [], [], [], [], []
                for doc_id, got in zip(rows["doc_id"].to_pylist(), enc.encode(rows["text"].to_pylist())):
                    got = np.concatenate([got, end])
                    first = (len(got) - 1) % capacity + 1
                    cuts = [0, *range(first, len(got) + 1, capacity)]
                    raw = memoryview(got.astype("<u4")).cast("B")
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        doc.append(doc_id), number.append(i), start.append(a), size.append(b - a)
                        crc.append(zlib.crc32(raw[4 * a:4 * b]))
                        if with_ids:
                            ids.append(got[a:b])
                arrays = [pa.array(doc, pa.int64()), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                          pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
                          pa.array(np.arange(unit, unit + len(doc)))]
                unit += len(doc)
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "unit"]
                yield pa.RecordBatch.from_arrays(
                    arrays + [list_array(ids)] * with_ids, names + ["ids"] * with_ids)

    return texts(docs).mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Fewest bins that any packing of ``sizes`` needs, by dual-feasible
    functions: the plain sum, and for each threshold the function that counts
    big items as whole bins and leaves out small ones, and the one that rounds
    items up to fractions 1/k of a bin."""
    counts = np.bincount(sizes.astype(np.int64), minlength=capacity + 1).astype(np.int64)
    return histogram_bound(counts, capacity)


def histogram_bound(counts: np.ndarray, capacity: int) -> int:
    """``lower_bound`` of ``counts[s]`` items of each size s."""
    size = np.arange(capacity + 1)
    total = int((counts * size).sum())
    best = -(-total // capacity)
    held = np.concatenate([[0], np.cumsum(counts)])          # items below a size
    tokens = np.concatenate([[0], np.cumsum(counts * size)])  # their tokens
    half = np.arange(1, capacity // 2 + 1)
    big = held[-1] - held[capacity - half + 1]               # sizes above capacity - threshold
    middle = tokens[capacity - half + 1] - tokens[half]      # threshold .. capacity - threshold
    if len(half):
        best = max(best, int((big + -(-middle // capacity)).max()))
    for k in range(1, 101):
        # u(x) = x where (k+1)x is whole, else floor((k+1)x)/k, x = size / capacity
        x = (k + 1) * size
        whole = x % capacity == 0
        value = np.where(whole, k * size, (x // capacity) * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and offset, and the bins' fill.
    Open bins wait by the room they have; a bit mask finds the tightest room."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fill = 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        need = int(sizes[i])
        fits = mask >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += need
        if room > need:
            by_room[room - need].append(b)
            mask |= 1 << (room - need)
    return bins, offsets, np.array(fill, np.int64)


def exact_fill(sizes: np.ndarray, items: list[int], capacity: int) -> list[list[int]]:
    """Bins of ``items`` (largest first), one after the other: the largest left, and
    of the others those whose sum fills its room best (all sums as bits of a number)."""
    left, out = list(items), []
    while left:
        first, left = left[0], left[1:]
        room = capacity - int(sizes[first])
        mask, sums, steps = (1 << room + 1) - 1, 1, []
        for place, i in enumerate(left):
            if sums >> room & 1:
                break
            if sizes[i] <= room:
                steps.append((place, sums))
                sums |= sums << int(sizes[i]) & mask
        rest, taken = sums.bit_length() - 1, set()
        for place, before in reversed(steps):
            if not before >> rest & 1:
                taken.add(place)
                rest -= int(sizes[left[place]])
        out.append([first, *(left[p] for p in sorted(taken))])
        left = [i for p, i in enumerate(left) if p not in taken]
    return out


def tighten(sizes: np.ndarray, bins: np.ndarray, offsets: np.ndarray, fill: np.ndarray, capacity: int):
    """Fill the open bins of a packing anew by exact sums, where that saves a bin."""
    open_bins = np.flatnonzero(fill < capacity)
    items = np.flatnonzero(fill[bins] < capacity)
    made = exact_fill(sizes, items[np.argsort(-sizes[items], kind="stable")].tolist(), capacity)
    if len(made) >= len(open_bins):
        return bins, offsets, fill
    number = np.cumsum(fill == capacity) - 1  # full bins keep their order
    bins, offsets, full = number[bins], offsets.copy(), fill[fill == capacity]
    new = []
    for b, members in enumerate(made):
        at = sizes[members]
        bins[members], offsets[members] = len(full) + b, np.cumsum(at) - at
        new.append(int(at.sum()))
    return bins, offsets, np.concatenate([full, np.array(new, np.int64)])


def pack_group(sizes: np.ndarray, capacity: int):
    """Bins and offsets of a group's pieces, the bins' fill, and the group's bound."""
    bins, offsets, fill = best_fit(sizes, capacity)
    bound = lower_bound(sizes, capacity)
    if len(fill) > bound:
        bins, offsets, fill = tighten(sizes, bins, offsets, fill, capacity)
    return bins, offsets, fill, bound


def _pack_groups(units: DataFrame, capacity: int, level: int) -> DataFrame:
    """Pack each ``home`` group of (unit, key, length, home); ``empty_rank`` and
    ``small_rank`` order its bins by room and by their number of pieces."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "key", "unit"], ascending=[False, True, True])
        sizes = pdf["length"].to_numpy()
        bins, offsets, fill, bound = pack_group(sizes, capacity)
        empty, small = np.empty(len(fill), np.int64), np.empty(len(fill), np.int64)
        empty[np.argsort(fill, kind="stable")] = np.arange(len(fill))
        small[np.argsort(-np.bincount(bins, minlength=len(fill)), kind="stable")] = np.arange(len(fill))
        return pd.DataFrame({
            "unit": pdf["unit"], "key": pdf["key"], "length": sizes, "home": pdf["home"], "bin": bins, "offset": offsets,
            "fill": fill[bins], "empty_rank": empty[bins], "small_rank": small[bins], "bins": len(fill), "bound": bound,
            "level": np.int32(level)})

    return units.groupBy("home").applyInPandas(run, _PACKED)


def pack(cut: DataFrame, capacity: int = 2048, group_pieces: int = 8192, largest_group: int = 1 << 16) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored ``pieces``, and the certificate of
    the group that settled each: its sequences ``group_bins`` and their lower bound
    ``group_bound`` (1 and 1 for a piece that is a whole sequence)."""
    part = cut.filter(F.col("length") < capacity).select(
        "unit", F.xxhash64("doc_id", "piece", "ids_crc32").alias("key"), "length")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in part.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    goal, groups = histogram_bound(counts, capacity), groups_for(int(counts.sum()), group_pieces)

    def dealt(units: DataFrame, level: int) -> DataFrame:
        return units.select("unit", "key", "length", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(groups)).alias("home"))

    def bins_of(packed: DataFrame) -> int:
        return packed.filter("offset = 0").count()

    state = materialize(_pack_groups(dealt(part, 0), capacity, 0), "packed-0")
    total, level, idle = bins_of(state), 0, 0
    while total > goal and idle < 2 and groups > 1:
        level += 1
        many = state.select("level", "home").distinct().count()
        share = F.greatest(F.col("bins") - F.col("bound"), F.lit(-(-(total - goal) // many))) * 2 ** level
        hands_over = ((F.col("fill") < capacity) & (F.col("empty_rank") < share)) | (F.col("small_rank") < share)
        given = materialize(state.filter(hands_over), f"given-{level}")
        held = given.count()
        groups_now = groups_for(held, group_pieces)
        units = given.select("unit", "key", "length", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(groups_now)).alias("home"))
        packed = materialize(_pack_groups(units, capacity, level), f"packed-{level}")
        gained = bins_of(given) - bins_of(packed)
        if gained > 0:
            state = materialize(state.filter(~hands_over).unionByName(packed), f"state-{level}")
            total, idle = total - gained, 0
        elif groups_now > 1 and group_pieces < largest_group:
            group_pieces = min(2 * group_pieces, largest_group)
        else:
            idle += 1
    number = F.col("level").cast("long") * (1 << 54) + F.col("home") * (1 << 24) + F.col("bin")
    found = state.select("unit", "offset", (number * 2 + 1).alias("sequence_id"),
                         F.col("bins").alias("group_bins"), F.col("bound").alias("group_bound"))
    whole = cut.filter(F.col("length") == capacity).select(
        *cut.columns, F.lit(0).cast("long").alias("offset"), (F.col("unit") * 2).alias("sequence_id"),
        F.lit(1).cast("long").alias("group_bins"), F.lit(1).cast("long").alias("group_bound"))
    return whole.unionByName(cut.filter(F.col("length") < capacity).join(found, "unit")).drop("unit")


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary: str | None = None,
                   with_ids: bool = False, **options) -> DataFrame:
    """Encode, cut and pack: one row per piece with its ``sequence_id`` and
    ``offset`` there, the certificate of its group (see ``pack``) and its ``ids``, if
    asked for."""
    cut = materialize(pieces(docs, capacity, end_id, vocabulary, with_ids), "pieces")
    return pack(cut, capacity, **options)
