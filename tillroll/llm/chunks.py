"""BPE ids by content-defined chunks that documents share.

Texts are cut where a rolling hash over the last ``SPAN`` characters has its low
bits zero, so equal passages give equal chunks wherever they stand. Documents go,
by one range exchange on (anchor, id), where their likes go: the anchor is the
smallest hash of a document's chunks, which near copies share, and a range splits
a hot anchor like any other. A task encodes each chunk once and lays the known
ids out for all its documents.

Ids at a chunk's ends may differ from those of the whole text. Each join is
repaired: the text around it is encoded again, from further and further out,
until both ends of the window stand on borders that the encoder keeps in any
context (before a blank between two other characters); there the window's ids
and the chunks' agree exactly.

Decoding lays out the bytes of the ids.

Edge cases: null and empty texts have no ids and decode to an empty text; texts
that hold a special token's string are encoded whole; very long texts are cut
like others; repeated rows are all encoded; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bpe import PieceEncoder, encoder
from tillroll.llm.common import texts
from tillroll.llm.token_files import list_array

#: characters the rolling hash looks back on
SPAN = 16
#: mean characters of a chunk (a power of two)
MEAN_CHUNK = 2048
#: characters of chunks a worker remembers; a full table is emptied
CACHE_CHARS = 24_000_000


def rolling_hash(cps: np.ndarray) -> np.ndarray:
    """Hash of the ``SPAN`` code points up to each place, by doubling: windows
    of 1, 2, 4 .. code points."""
    h = (cps.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    factor, width = 0xD6E8FEB86659FD93, 1
    while width < SPAN:
        back = h[:-width] * np.uint64(factor)
        h = h.copy()
        h[width:] += back
        factor, width = factor * factor % 2**64, 2 * width
    return h


def cuts(text: str) -> list[int]:
    """Borders of the text's chunks, 0 and its end included."""
    n = len(text)
    if n <= MEAN_CHUNK // 4:
        return [0, n] if n else [0]
    h = rolling_hash(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
    h *= np.uint64(0x9E3779B97F4A7C15)
    at = np.flatnonzero((h >> np.uint64(40)) % np.uint64(MEAN_CHUNK) == 0) + 1
    return [0, *at[(at > SPAN) & (at < n)].tolist(), n]


def chunks(text: str) -> list[str]:
    c = cuts(text)
    return [text[a:b] for a, b in zip(c, c[1:])]


def anchored(docs: DataFrame) -> DataFrame:
    """``texts(docs)`` with ``anchor``, the smallest chunk hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [min((hashlib.blake2b(c.encode("utf-8", "surrogatepass"), digest_size=7).digest() for c in chunks(t)), default=b"")
                   for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([int.from_bytes(x, "big") for x in low], pa.int64())], [*batch.schema.names, "anchor"])

    return texts(docs).mapInArrow(run, "doc_id long, text string, anchor long")


def _kept_border(text: str, at: int) -> bool:
    """Whether the encoder splits before ``at`` in any context: a blank there,
    other characters on both sides of it."""
    return 0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()


def _window(text: str, at: int) -> tuple[int, int]:
    """Kept borders around a join, or the text's ends."""
    a = at - 1
    while a > 0 and not _kept_border(text, a):
        a = max(0, text.rfind(" ", 0, a))
    b = at
    while b < len(text) and not _kept_border(text, b):
        b = text.find(" ", b + 1)
        b = len(text) if b < 0 else b
    return a, b


class ChunkEncoder:
    """Encodes texts by chunks it has seen; ids are those of the whole texts."""

    def __init__(self, enc: PieceEncoder):
        self.enc = enc
        self.known: dict[str, np.ndarray] = {}
        self.held = 0
        size = [len(b) for b in token_bytes(enc)]
        self.sizes = np.array(size, np.int64)
        self.reused = self.encoded = 0

    def _learn(self, wanted: list[str]) -> None:
        new = [c for c in dict.fromkeys(wanted) if c not in self.known]
        self.reused += len(wanted) - len(new)
        self.encoded += len(new)
        if self.held > CACHE_CHARS:
            self.known.clear()
            self.held, new = 0, list(dict.fromkeys(wanted))
        for c, ids in zip(new, self.enc.encode(new)):
            self.known[c] = ids.astype(np.uint16) if len(self.sizes) <= 1 << 16 else ids
            self.held += len(c)

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        whole = [any(s in t for s in self.enc.special) for t in batch]
        borders = [[0] if w else cuts(t) for t, w in zip(batch, whole)]
        parts = [[t[a:b] for a, b in zip(c, c[1:])] for t, c in zip(batch, borders)]
        self._learn([p for ps in parts for p in ps])
        windows: list[list[tuple[int, int]]] = []
        for text, c in zip(batch, borders):
            own: list[tuple[int, int]] = []
            for at in c[1:-1]:
                a, b = _window(text, at)
                if own and a < own[-1][1]:  # windows that meet are one
                    a, b = min(a, own[-1][0]), max(b, own[-1][1])
                    own.pop()
                own.append((a, b))
            windows.append(own)
        mended = iter(self.enc.encode([t[a:b] for t, own in zip(batch, windows) for a, b in own]))
        rest = iter(self.enc.encode([t for t, w in zip(batch, whole) if w]))
        out = []
        for text, w, c, ps, own in zip(batch, whole, borders, parts, windows):
            if w:
                out.append(next(rest))
                continue
            pieces, at, i = [], 0, 0
            for a, b in [*own, (len(text), len(text))]:
                # known ids of text[at:a], chunk by chunk; both ends are kept borders
                while i < len(ps) and c[i] < a:
                    if c[i + 1] > at:
                        pieces.append(self._slice(ps[i], max(at - c[i], 0), min(a, c[i + 1]) - c[i]))
                    if c[i + 1] > a:
                        break
                    i += 1
                if a < len(text) or b > a:
                    pieces.append(next(mended))
                at = b
            out.append(np.concatenate(pieces).astype(np.uint32) if pieces else np.empty(0, np.uint32))
        return out

    def _slice(self, chunk: str, a: int, b: int) -> np.ndarray:
        """The chunk's ids of chunk[a:b], where a and b are borders between ids."""
        ids = self.known[chunk]
        if a == 0 and b == len(chunk):
            return ids
        ends = np.cumsum(self.sizes[ids])
        lo = len(chunk[:a].encode("utf-8", "surrogatepass")) if a else 0
        hi = int(ends[-1]) - len(chunk[b:].encode("utf-8", "surrogatepass"))
        i, j = (int(np.searchsorted(ends, lo, side="right")) if lo else 0), int(np.searchsorted(ends, hi, side="right"))
        if (i and ends[i - 1] != lo) or (j and ends[j - 1] != hi):
            raise AssertionError("a kept border lies inside an id")
        return ids[i:j]


def token_bytes(enc: PieceEncoder) -> list[bytes]:
    """The bytes of every id."""
    back = {ord(c): b for b, c in enc.letters.items()}
    special = {i: t.content.encode() for i, t in enc.tok.get_added_tokens_decoder().items()}
    words = {i: w for w, i in enc.tok.get_vocab(with_added_tokens=True).items()}
    return [special.get(i) or words.get(i, "").translate(back).encode("latin-1") for i in range(max(words) + 1)]


class Decoder:
    """Texts of ids, as the library's ``decode(ids, skip_special_tokens=False)``."""

    def __init__(self, enc: PieceEncoder):
        raw = token_bytes(enc)
        self.size = np.array([len(b) for b in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    def raw(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        return self.bytes[np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1])].tobytes()

    def text(self, ids: np.ndarray) -> str:
        return self.raw(ids).decode("utf-8", "replace")


_STATE: dict[str, tuple[ChunkEncoder, Decoder]] = {}


def _tools(vocabulary: str | None) -> tuple[ChunkEncoder, Decoder]:
    enc = encoder(vocabulary)
    key = vocabulary or ""
    if key not in _STATE:
        _STATE[key] = ChunkEncoder(enc), Decoder(enc)
    return _STATE[key]


def encode_documents(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (if asked for) and the SHA-256 of the
    ids (little-endian 32-bit) and of the decoded text, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_chunk, decoder = _tools(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = by_chunk.encode(rows["text"].to_pylist())
                arrays = [
                    rows["doc_id"], pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(decoder.text(x).encode("utf-8", "surrogatepass")).hexdigest() for x in ids])]
                yield pa.RecordBatch.from_arrays(
                    arrays + [list_array(ids)] * with_ids,
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)

    order = [F.col("anchor"), F.col("doc_id")]
    near = anchored(docs).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return near.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
