"""Exact byte-level BPE ids, one library call per distinct piece.

The tokenizers library merges inside the pieces its pre-tokenizer cuts and
never across them, so a text's ids are its pieces' ids in a row.
``PieceEncoder`` finds the piece borders of a whole batch of texts with array
operations, hands every piece it has not seen to the library once, and lays the
known ids out again. A piece is known by a random 64-bit key, not by its text, so
that a worker holds numbers alone. Letter, digit and space classes are asked of the library's
own pre-tokenizer, not of a second Unicode table.

Texts that the fast path does not cover (code points above U+FFFF, text of a
special token) are encoded by the library as they are.
"""

from __future__ import annotations

import codecs

import numpy as np
import pandas as pd

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
# pieces kept per worker; a full table is emptied (bounds memory, not results)
CACHE_PIECES = 700_000
# pieces the library gets as one text
LINES = 500
# code points handled at a time: about 60 bytes of arrays for each
BATCH_CHARS = 500_000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str | None = None):
    """The library's tokenizer of a vocabulary file, truncation and padding off."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path or vocabulary_path())
    tok.no_truncation()
    tok.no_padding()
    return tok


def _classes(tok) -> np.ndarray:
    """Class of every code point below U+10000, as the pre-tokenizer sees it:
    a character shares the piece of a letter, digit or sign before it."""
    points = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    table = np.full(0x10000, SPACE, np.uint8)
    codes = np.array([ord(c) for c in points])
    for lead, kind in (("a", LETTER), ("1", DIGIT), ("!", OTHER)):
        text = "".join(f"{lead}{c}\n" for c in points)
        starts = {a for _, (a, _) in tok.pre_tokenizer.pre_tokenize_str(text)}
        joined = np.array([3 * i + 1 not in starts for i in range(len(points))])
        table[codes[joined]] = kind
    return table


def piece_starts(cps: np.ndarray, cls: np.ndarray, doc_start: np.ndarray) -> np.ndarray:
    """Where the pieces start. ``cps`` holds the code points of several
    non-empty texts in a row, ``doc_start`` the first index of each."""
    n = len(cps)
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(cls[1:], cls[:-1], out=edge[1:])
    edge[doc_start] = True
    s = np.flatnonzero(edge)
    e = np.append(s[1:], n)
    kind = cls[s]
    first = np.zeros(n, bool)
    first[doc_start] = True
    first = first[s]
    more = np.append(~first[1:], False)  # another run of the same text follows

    word = kind != SPACE
    glued = np.zeros(len(s), bool)  # takes the blank before it
    glued[1:] = word[1:] & ~first[1:] & (kind[:-1] == SPACE) & (cps[s[1:] - 1] == 32)
    at = np.where(glued, s - 1, s)

    # 's 't 'm 'd 're 've 'll right after a lone apostrophe
    quote = np.flatnonzero(
        (kind == OTHER) & (e - s == 1) & (cps[s] == 39) & ~glued & more & np.append(kind[1:] == LETTER, False)
    )
    tail_starts = np.empty(0, np.int64)
    keep = np.ones(len(s), bool)
    if len(quote):
        a = cps[s[quote] + 1]
        two = np.minimum(s[quote] + 2, n - 1)
        b = np.where(e[quote + 1] - s[quote + 1] > 1, cps[two], 0)
        size = np.where(np.isin(a, [115, 116, 109, 100]), 1, 0)
        size = np.where(((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108), 2, size)
        quote, size = quote[size > 0], size[size > 0]
        keep[quote + 1] = False
        rest = s[quote] + 1 + size
        tail_starts = rest[rest < e[quote + 1]]

    blank = np.flatnonzero(~word)
    inner = more[blank]
    long = e[blank] - s[blank] > 1
    lone = inner & (cps[e[blank] - 1] != 32)
    return np.sort(np.concatenate([
        at[word & keep],
        tail_starts,
        s[blank[~inner]],                 # spaces at the end of a text: one piece
        s[blank[inner & long]],           # all but the last of a longer run
        e[blank[lone]] - 1,               # a last space that is no blank: its own
    ]))


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself
    where it can be printed, else the next free code point from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def _random_words(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, np.uint64)


class PieceEncoder:
    """Encodes batches of texts exactly as the library's ``encode`` does with
    ``add_special_tokens=False``."""

    def __init__(self, path: str | None = None):
        self.tok = load_tokenizer(path)
        self.table = _classes(self.tok)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        from tokenizers import Tokenizer, pre_tokenizers

        # a byte's letter in the model's alphabet; the model alone, cut at line breaks;
        # how many bytes each of its ids stands for
        self.letters = _byte_letters()
        self.alphabet = "".join(self.letters[b] for b in range(256))
        self.by_line = Tokenizer(self.tok.model)
        self.by_line.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(self.letters[10])
        words = self.by_line.get_vocab()
        self.id_bytes = np.zeros(max(words.values()) + 1, np.int64)
        self.id_bytes[list(words.values())] = list(map(len, words))
        self.mix, self.weights = _random_words(0x10000, 1), _random_words(256, 2) | np.uint64(1)
        self._reset()

    def _reset(self) -> None:
        # keys of known pieces, ascending, and each one's place in start and size
        self.keys = np.empty(0, np.uint64)
        self.number = np.empty(0, np.int32)
        self.start = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _learn(self, pieces: list[str], keys: np.ndarray) -> None:
        """Ids of new pieces with their keys. All but blank ones go to the library's
        model, a piece on each line, with their bytes already in the model's alphabet;
        the ids' bytes tell where each piece ends."""
        blank = np.fromiter(map(str.isspace, pieces), bool, len(pieces))
        blanks = [pieces[i] for i in np.flatnonzero(blank).tolist()]
        words = [p for p in pieces if not p.isspace()] if blanks else pieces
        raw = "".join([f"{w}\n" for w in words]).encode("utf-8", "surrogatepass")
        breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
        cut = [0, *(breaks[LINES - 1:-1:LINES] + 1).tolist(), len(raw)]
        got = self.by_line.encode_batch_fast(
            [codecs.charmap_decode(raw[a:b], "strict", self.alphabet)[0] for a, b in zip(cut, cut[1:])], add_special_tokens=False)
        flat = np.concatenate([np.array(x.ids, np.uint32) for x in got])
        id_ends, word_ends = np.cumsum(self.id_bytes[flat]), breaks - np.arange(len(breaks))
        last = np.searchsorted(id_ends, word_ends)
        if len(breaks) == len(words) and np.array_equal(id_ends[last[last < len(flat)]], word_ends):
            self._keep(keys[~blank], flat, np.diff(last, prepend=-1))
        else:  # a line break inside a piece, or bytes that the model leaves out
            blanks, blank = pieces, np.ones(len(pieces), bool)
        if blanks:
            got = [x.ids for x in self.tok.encode_batch(blanks, add_special_tokens=False)]
            self._keep(keys[blank], np.array([i for x in got for i in x], np.uint32), np.array([len(x) for x in got]))

    def _keep(self, keys: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.keys), len(keys)
        while n + m > len(self.size):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.size[n:n + m] = sizes
        self.start[n:n + m] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        order = np.argsort(keys)
        place = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, place, keys[order])
        self.number = np.insert(self.number, place, (n + order).astype(np.int32))

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the pieces with these keys, -1 where one is not known."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.number[at], np.int32(-1))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        group, chars = [], 0
        for i, text in enumerate(texts):
            if text:
                group.append(i)
                chars += len(text)
            if chars >= BATCH_CHARS:
                self._group(texts, group, out)
                group, chars = [], 0
        if group:
            self._group(texts, group, out)
        return out

    def _group(self, texts: list[str], group: list[int], out: list[np.ndarray]) -> None:
        text = "".join([texts[i] for i in group])
        cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if cps.max() < 0x10000 and not any(t in text for t in self.special):
            return self._fast(text, cps, texts, group, out)
        fast = []
        for i in group:
            if max(texts[i]) < "\U00010000" and not any(t in texts[i] for t in self.special):
                fast.append(i)
            else:
                out[i] = np.array(self.tok.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        if fast:
            self._group(texts, fast, out)

    def _mixed(self, at: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A random 64-bit value for each code point at its place in a piece;
        their sum, the piece's key, tells pieces apart: of a batch's and the known ones,
        a million together, two different ones meet with odds of 1 in 10 million."""
        longest = int(size.max())
        if longest > len(self.weights):
            self.weights = _random_words(2 * longest, 2) | np.uint64(1)
        place = np.arange(len(at))
        place -= np.repeat(starts, size)
        mixed = self.mix[at]
        mixed *= self.weights[place]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        return mixed

    def _fast(self, text: str, cps: np.ndarray, texts: list[str], group: list[int], out: list[np.ndarray]) -> None:
        lens = np.array([len(texts[i]) for i in group])
        doc_start = np.cumsum(lens) - lens
        at = cps.astype(np.intp)
        starts = piece_starts(cps, self.table[at], doc_start)
        size = np.diff(np.append(starts, len(cps)))
        key = np.add.reduceat(self._mixed(at, starts, size), starts)
        code, key = pd.factorize(key)
        first = np.empty(code.max() + 1, np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        ends = starts + size
        number = self._find(key)
        new = np.flatnonzero(number < 0)
        if len(new):
            if len(self.keys) > CACHE_PIECES:
                self._reset()
                new = np.arange(len(key))
            at = first[new]
            self._learn([text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())], key[new])
            number[new] = self._find(key[new])
        number = number[code]
        n_ids = self.size[number]
        ends = np.cumsum(n_ids)
        ids = self.ids[np.repeat(self.start[number] - (ends - n_ids), n_ids) + np.arange(ends[-1])]
        cut = np.concatenate([[0], ends])[np.searchsorted(starts, np.append(doc_start, len(cps)))]
        for k, i in enumerate(group):
            out[i] = ids[cut[k]:cut[k + 1]]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str | None = None) -> PieceEncoder:
    """The worker's encoder of a vocabulary file, made once per process."""
    path = path or vocabulary_path()
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
