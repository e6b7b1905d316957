"""Alignment of two tokenizers over the same bytes, by sparse incidence products.

Encoding A is byte-level BPE of a space and the text, encoding B the sentencepiece
model's of the text (which adds the space). Over the joined bytes of a batch of
texts each encoding is a token-byte incidence matrix in CSR form. Gustavson's row
products of A with B transposed give the overlap links and, as values, the bytes
that two tokens share. Where tokens of both end, the bytes are cut into groups;
token-group incidence matrices and their product give the shared-group links.

Documents are encoded once, where they lie; what is stored of each is one row with
its distinct id pairs and how often they are linked. The corpus-wide count of an
id pair and the best count of each A id come from one aggregate over those pairs.
The counts go back to the documents in two ways: the pairs of the most documents,
at most ``FREQUENT`` of them, are broadcast, the others are joined by a shuffle in
which no key holds more than 2 parts in ``FREQUENT`` of the rows.

Edge cases: null and empty texts, and texts whose tokens' bytes are not the text's
(such as those with U+2581), have no tokens, zeros and an empty digest; special
strings are plain text; repeated rows are documents of their own; null ids are
kept; other columns are ignored; very long texts are one batch; no rows: no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bpe import PieceEncoder
from tillroll.llm.common import frequent as most_frequent
from tillroll.llm.common import materialize, texts
from tillroll.llm.piece_counts import SPACE, char_groups, model
from tillroll.session import ensure_checkpoint_dir

#: bits of a token id in a pair: a * 2^20 + b
ID_BITS = 20
#: at most so many id pairs are broadcast (two longs and a flag each)
FREQUENT = 200_000
# products of shared-group links made at a time, code points aligned at a time, pieces
# a worker remembers (memory only)
BLOCK_PRODUCTS, BATCH_CHARS, HELD_PIECES = 1 << 20, 250_000, 400_000

ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, "
           "groups_sha256 string, links array<long>, times array<long>")


class Csr(NamedTuple):
    """A sparse matrix by rows: those of row i lie at indptr[i]:indptr[i + 1]."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))


def row_products(a: Csr, b: Csr, columns: int) -> Csr:
    """The product a·b by Gustavson's rule: row i is the sum of b's rows k, each
    times a[i, k], over a's row i. ``columns`` is the width of b."""
    begin = b.indptr[a.indices]
    width = b.indptr[a.indices + 1] - begin
    ends = np.cumsum(width)
    at = np.repeat(begin - (ends - width), width) + np.arange(ends[-1] if len(ends) else 0)
    place = np.repeat(a.rows(), width) * columns + b.indices[at]
    value = np.repeat(a.data, width) * b.data[at]
    if np.any(place[1:] < place[:-1]):
        order = np.argsort(place, kind="stable")
        place, value = place[order], value[order]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    row, column = np.divmod(place[first], max(columns, 1))
    indptr = np.searchsorted(row, np.arange(len(a.indptr)))
    return Csr(indptr, column, np.add.reduceat(value, first) if len(first) else value)


class Spans(NamedTuple):
    """Tokens of several texts in a row: their ids, byte ends, and first of each text."""

    ids: np.ndarray
    ends: np.ndarray
    cut: np.ndarray

    def text(self) -> np.ndarray:
        """The text of each token."""
        return np.repeat(np.arange(len(self.cut) - 1), np.diff(self.cut))

    def by_byte(self) -> Csr:
        """Token-byte incidence: row t holds the bytes of token t."""
        total = int(self.ends[-1]) if len(self.ends) else 0
        return Csr(np.concatenate([[0], self.ends]), np.arange(total), np.ones(total, np.int64))

    def of_byte(self) -> Csr:
        """Its transpose: row i holds the one token of byte i."""
        total = int(self.ends[-1]) if len(self.ends) else 0
        owner = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        return Csr(np.arange(total + 1), owner, np.ones(total, np.int64))


class Alignment(NamedTuple):
    """Two encodings of several texts, their groups' ends, and the groups of tokens."""

    a: Spans
    b: Spans
    group_ends: np.ndarray
    group_of_a: np.ndarray
    group_of_b: np.ndarray

    def overlaps(self) -> Csr:
        """A tokens x B tokens: the bytes that they share."""
        return row_products(self.a.by_byte(), self.b.of_byte(), len(self.b.ids))

    def in_group(self) -> Csr:
        """A tokens x groups."""
        n = len(self.group_of_a)
        return Csr(np.arange(n + 1), self.group_of_a, np.ones(n, np.int64))

    def of_group(self) -> Csr:
        """Groups x B tokens."""
        n = len(self.group_of_b)
        return Csr(np.searchsorted(self.group_of_b, np.arange(len(self.group_ends) + 1)), np.arange(n), np.ones(n, np.int64))

    def shared_counts(self) -> np.ndarray:
        """Shared-group links of each A token: the product of the incidences with
        a column of ones, without the links themselves."""
        sizes = np.diff(self.of_group().indptr)
        ones = Csr(np.arange(len(sizes) + 1), np.zeros(len(sizes), np.int64), sizes)
        return row_products(self.in_group(), ones, 1).data

    def shared(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Shared-group links (A token, B token), in blocks of A tokens."""
        work, group = np.cumsum(self.shared_counts()), self.of_group()
        begin = 0
        while begin < len(work):
            done = work[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(work, done + BLOCK_PRODUCTS, "right")))
            n = end - begin
            block = Csr(np.arange(n + 1), self.group_of_a[begin:end], np.ones(n, np.int64))
            links = row_products(block, group, len(self.b.ids))
            yield links.rows() + begin, links.indices
            begin = end


class PlainEncoder(PieceEncoder):
    """Byte-level ids, special strings in a text being plain text."""

    def __init__(self, path: str | None = None):
        super().__init__(path)
        self.tok.encode_special_tokens = True
        self.special = []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.keys) > HELD_PIECES:
            self._reset()
        return super().encode(texts)


class PieceIds:
    """Ids of the sentencepiece model: texts are cut where nothing is merged, and a
    worker asks the library once for each pre-token it meets."""

    def __init__(self, path: str | None = None):
        self.model = model(path)
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.start, self.size, self.ids = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.used = 0

    def _learn(self, fresh: list[str]) -> None:
        made, n = self.model, len(self.known)
        got = [ids[made.fence_size:] for ids in made.sp.encode([made.fence + p for p in fresh], num_threads=1)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter(chain.from_iterable(got), np.int64, int(sizes.sum()))
        while n + len(fresh) > len(self.size):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.size[n:n + len(fresh)] = sizes
        self.start[n:n + len(fresh)] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        self.known.update(zip(fresh, range(n, n + len(fresh))))

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        if len(self.known) > HELD_PIECES:
            self._reset()
        rows = self.model.pre_tokens(batch)
        parts = list(chain.from_iterable(rows))
        number = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        new = np.flatnonzero(number < 0).tolist()
        if new:
            self._learn(list(dict.fromkeys([parts[i] for i in new])))
            number[new] = [self.known[parts[i]] for i in new]
        sizes = self.size[number]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.start[number] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.cumsum([0, *map(len, rows)])])


class Spelling(NamedTuple):
    """The bytes of a vocabulary's tokens in a row."""

    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Spelling:
        size = np.array([len(x) for x in tokens])
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class Aligner:
    """Both encodings of batches of texts, and the bytes of their tokens."""

    def __init__(self, a_path: str | None = None, b_path: str | None = None):
        self.enc, self.pieces, self.sp = PlainEncoder(a_path), PieceIds(b_path), model(b_path).sp
        byte = {letter: b for b, letter in self.enc.letters.items()}
        size = self.enc.tok.get_vocab_size()
        self.a_bytes = [bytes(byte[c] for c in self.enc.tok.id_to_token(i)) for i in range(size)]
        self.b_bytes = [
            bytes([int(self.sp.id_to_piece(i)[3:-1], 16)]) if self.sp.is_byte(i)
            else self.sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(self.sp.get_piece_size())]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << ID_BITS:
            raise ValueError("token ids beyond the bits of a pair")
        self.a_spelling, self.b_spelling = Spelling.of(self.a_bytes), Spelling.of(self.b_bytes)
        names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names = np.array([[n + sign for n in names] for sign in ",|;"], object)

    def encode(self, batch: list[str]) -> tuple[np.ndarray, Spans, Spans]:
        """Which texts both encodings spell byte for byte, and their tokens."""
        spelt = [(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in batch]
        raw, width = np.frombuffer(b"".join(spelt), np.uint8), np.fromiter(map(len, spelt), np.int64, len(spelt))
        a = self.enc.encode([" " + t if t else "" for t in batch])
        both = [(np.concatenate(a).astype(np.int64) if a else np.empty(0, np.int64), np.fromiter(map(len, a), np.int64, len(a))),
                self.pieces.encode(batch)]
        exact = width > 0
        for (ids, n), spelling in zip(both, (self.a_spelling, self.b_spelling)):
            bytes_of = np.diff(np.concatenate([[0], np.cumsum(spelling.size[ids])])[np.cumsum([0, *n])])
            exact &= bytes_of == width
        for (ids, n), spelling in zip(both, (self.a_spelling, self.b_spelling)):
            differs = spelling.spell(ids[np.repeat(exact, n)]) != raw[np.repeat(exact, width)]
            if differs.any():
                text = np.repeat(np.flatnonzero(exact), width[exact])
                exact[text[differs]] = False

        def spans(ids: np.ndarray, n: np.ndarray, spelling: Spelling) -> Spans:
            kept = ids[np.repeat(exact, n)]
            return Spans(kept, np.cumsum(spelling.size[kept]), np.cumsum([0, *n[exact]]))

        return np.flatnonzero(exact), spans(*both[0], self.a_spelling), spans(*both[1], self.b_spelling)

    def align(self, batch: list[str]) -> tuple[np.ndarray, Alignment]:
        exact, a, b = self.encode(batch)
        total = int(a.ends[-1]) if len(a.ends) else 0
        ends_a, ends_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        ends_a[a.ends], ends_b[b.ends] = True, True
        last_a, last_b = ends_b[a.ends], ends_a[b.ends]  # tokens that end a group
        return exact, Alignment(a, b, a.ends[last_a], np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b)

    def digests(self, got: Alignment) -> list[str]:
        """Digest of each text's groups, written a1,a2|b1;a3|b2,b3 in ids."""
        a, b = got.a, got.b
        first_b = np.searchsorted(got.group_of_b, np.arange(len(got.group_ends) + 1))
        first_a = np.searchsorted(got.group_of_a, np.arange(len(got.group_ends) + 1))
        parts = np.empty(len(a.ids) + len(b.ids), object)
        last_a, last_b = np.diff(got.group_of_a, append=-1) != 0, np.diff(got.group_of_b, append=-1) != 0
        parts[np.arange(len(a.ids)) + first_b[got.group_of_a]] = self.names[last_a.astype(int), a.ids]
        parts[np.arange(len(b.ids)) + first_a[got.group_of_b + 1]] = self.names[2 * last_b.astype(int), b.ids]
        cut, signs = (a.cut + b.cut).tolist(), parts.tolist()
        return [hashlib.sha256("".join(signs[i:j])[:-1].encode()).hexdigest() for i, j in zip(cut, cut[1:])]


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(a_path: str | None, b_path: str | None) -> Aligner:
    """The worker's aligner, made once per process."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _per_text(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one per token) over each text."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[cut])


def link_rows(docs: DataFrame, kind: str = "overlap", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per link: ``doc_id``, the tokens' places ``a_at`` and ``b_at`` in
    their encodings and their ids. ``kind`` is "overlap" (bytes in common) or
    "group" (same group); every overlap is also a link of its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, _, group in char_groups(batch["text"], BATCH_CHARS):
                exact, got = aligner(a_path, b_path).align(group)
                over = got.overlaps() if kind == "overlap" else None
                doc_ids = batch["doc_id"].take(pa.array(begin + exact))
                for a, b in [(over.rows(), over.indices)] if over else got.shared():
                    text = got.a.text()[a]
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.take(pa.array(text)), pa.array(a - got.a.cut[text]), pa.array(b - got.b.cut[text]),
                         pa.array(got.a.ids[a]), pa.array(got.b.ids[b])], ["doc_id", "a_at", "b_at", "a_id", "b_id"])

    return texts(docs).mapInArrow(run, "doc_id long, a_at long, b_at long, a_id long, b_id long")


def aligned_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Stored rows of documents: counts, the digest of the groups, the distinct id
    pairs that overlap (``links``) and how often each does (``times``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for begin, end, group in char_groups(batch["text"], BATCH_CHARS):
                made = aligner(a_path, b_path)
                exact, got = made.align(group)
                n, over = end - begin, got.overlaps()
                of_a = over.rows()
                place = (got.a.text()[of_a] << 2 * ID_BITS) | (got.a.ids[of_a] << ID_BITS) | got.b.ids[over.indices]
                pair, times = np.unique(place, return_counts=True)

                def spread(values: np.ndarray) -> np.ndarray:
                    out = np.zeros(n, np.int64)
                    out[exact] = values
                    return out

                digest = np.full(n, "", object)
                digest[exact] = made.digests(got)
                sizes = spread(np.bincount(pair >> 2 * ID_BITS, minlength=len(exact)))
                cut = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                is_end = np.diff(got.group_of_a, append=-1) != 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), batch["doc_id"].slice(begin, n),
                     pa.array(spread(np.diff(got.a.cut))), pa.array(spread(np.diff(got.b.cut))),
                     pa.array(spread(_per_text(is_end, got.a.cut))), pa.array(spread(_per_text(np.diff(over.indptr), got.a.cut))),
                     pa.array(spread(_per_text(got.shared_counts(), got.a.cut))), pa.array(digest.tolist(), pa.string()),
                     pa.ListArray.from_arrays(cut, pa.array(pair & ((1 << 2 * ID_BITS) - 1))),
                     pa.ListArray.from_arrays(cut, pa.array(times.astype(np.int64)))],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "links", "times"])
                row += n

    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/aligned-{uuid.uuid4().hex}"
    # sorted pairs: small steps, so delta encoding
    options = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#links.list.element": "false"}
    texts(docs).mapInArrow(run, ALIGNED).write.options(**options).parquet(path)
    return spark.read.schema(ALIGNED).parquet(path)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Stored table of id pairs: ``link``, ``docs`` (documents that hold it) and
    ``best`` (no other B token of its A id has more)."""
    a_id = F.shiftright("link", ID_BITS).alias("a_id")
    pairs = aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count(F.lit(1)).alias("docs"))
    pairs = materialize(pairs, "pairs")
    top = pairs.groupBy(a_id).agg(F.max("docs").alias("top"))
    rated = pairs.withColumn("a_id", a_id).join(top, "a_id")
    return materialize(rated.select("link", "docs", (F.col("docs") == F.col("top")).alias("best")), "rated-pairs")


def alignment_counts(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
                     frequent: int = FREQUENT) -> DataFrame:
    """One row per document: its tokens, groups and links, how many links are their
    A id's best (``n_best``), and the sum of the links' counts (``count_sum``)."""
    aligned = aligned_documents(docs, a_path, b_path)
    rated = pair_counts(aligned)
    often = most_frequent(rated, "docs", frequent)
    common, rare = rated.filter(often), rated.filter(~often)
    held = aligned.select("row", F.explode(F.arrays_zip("links", "times")).alias("at"))
    held = held.select("row", F.col("at.links").alias("link"), F.col("at.times").alias("times"))
    parts = [held.join(F.broadcast(common), "link"),
             held.join(F.broadcast(common.select("link")), "link", "left_anti").join(rare, "link")]
    best, total = F.when(F.col("best"), F.col("times")).otherwise(0), F.col("docs") * F.col("times")
    sums = [p.groupBy("row").agg(F.sum(best).alias("n_best"), F.sum(total).alias("count_sum")) for p in parts]
    sums = sums[0].unionByName(sums[1]).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    counted = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return aligned.drop("links", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *counted, "groups_sha256", "n_shared")
