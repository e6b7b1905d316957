"""Token counts against sentencepiece, alignments against a plain loop over byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd import ODD_SCHEMA, empty_documents, odd_documents
from tillroll.llm import alignment, bpe, piece_counts, queries
from tillroll.llm.common import table

SMALL = "/root/testdata/sf0.001"


def hard_documents(spark):
    """Texts that are hard to cut: spaces in runs, the space sign itself, control
    characters, special strings, bytes without pieces, one endless word."""
    texts = ["  a  b ", " ", "\n\n\t x", "▁a▁▁b c", "<s> </s> <unk> <0x41> <|endoftext|>", "a\x00b\x01", "日本語 ﬁ①é",
             "\U0001F600\U0001F468‍\U0001F469 ok", "x" * 5000, "=" * 777 + "-" * 333, "3.14159 1,000,000", "\r\n", "ab" * 40 + " " + "ab" * 40]
    rng = random.Random(5)
    texts += ["".join(rng.choice("ab the  \n\t1.,'éß▁日") for _ in range(rng.randint(1, 300))) for _ in range(40)]
    return spark.createDataFrame([(i // 2, t, None, "s", 1, 1, 2, 3) for i, t in enumerate(texts)], ODD_SCHEMA)


SOURCES = [odd_documents, empty_documents, hard_documents, None]


def documents(spark, rows):
    docs = rows(spark) if rows else table(spark, SMALL, "documents")
    for name in ("key", "rows", "pieces", "links", "times", "n_bytes"):  # names the operators use themselves
        docs = docs.withColumn(name, F.lit("7"))
    return docs


def listed(rows):
    return sorted(((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, rows)))


@pytest.mark.parametrize("rows", SOURCES)
@pytest.mark.parametrize("frequent", [3, 100_000])
def test_token_counts(spark, rows, frequent):
    docs = documents(spark, rows)
    sp = piece_counts.model().sp
    got = piece_counts.token_counts(docs, limit=50, frequent=frequent)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for r in docs.collect():
        n = len(sp.encode(r.text or ""))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 50))
    assert listed(got.collect()) == listed(want)


def test_each_pre_token_is_counted_once(spark):
    docs = documents(spark, None)
    known = piece_counts.vocabulary(docs).collect()
    assert len({r.key for r in known}) == len(known)
    made, held = piece_counts.model(), Counter()
    for r in docs.collect():
        parts = made.pre_tokens([r.text or ""])[0]
        assert "".join(parts) == (" " + r.text.replace("▁", " ") if r.text else "")
        held.update({piece_counts.key_of(p) for p in parts})
    assert {r.key: r.rows for r in known} == held


def bytes_of(vocabulary_id, piece, alphabet=None):
    if alphabet:
        return bytes(alphabet[c] for c in piece)
    return bytes([int(piece[3:-1], 16)]) if len(piece) == 6 and piece[:3] == "<0x" else piece.replace("▁", " ").encode()


def brute_alignment(rows):
    tok, sp = bpe.load_tokenizer(), piece_counts.model().sp
    tok.encode_special_tokens = True
    alphabet = {letter: b for b, letter in bpe._byte_letters().items()}
    docs, holds = [], Counter()
    for r in rows:
        text = " " + r.text if r.text else ""
        a = tok.encode(text, add_special_tokens=False).ids if text else []
        b = sp.encode(r.text or "")
        spelt = [[bytes_of(i, tok.id_to_token(i), alphabet) for i in a], [bytes_of(i, sp.id_to_piece(i)) for i in b]]
        if not text or any(b"".join(s) != text.encode() for s in spelt):
            a, b, spelt = [], [], [[], []]
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelt]
        starts = [[0, *e[:-1]] for e in ends]
        links = [(x, y) for x in range(len(a)) for y in range(len(b))
                 if starts[0][x] < ends[1][y] and starts[1][y] < ends[0][x]] if len(a) < 400 else None
        if links is None:  # the same by two pointers
            links, y = [], 0
            for x in range(len(a)):
                while ends[1][y] <= starts[0][x]:
                    y += 1
                z = y
                while z < len(b) and starts[1][z] < ends[0][x]:
                    links.append((x, z))
                    z += 1
        groups, shared, i, j = [], 0, 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            shared, i, j = shared + (k - i) * (m - j), k, m
        pairs = [(a[x], b[y]) for x, y in links]
        holds.update(set(pairs))
        docs.append((r.doc_id, len(a), len(b), len(groups), pairs, shared, ";".join(groups)))
    best = defaultdict(int)
    for (a_id, _), n in holds.items():
        best[a_id] = max(best[a_id], n)
    return [(doc_id, n_a, n_b, n_groups, len(pairs), sum(holds[p] == best[p[0]] for p in pairs), sum(holds[p] for p in pairs),
             hashlib.sha256(text.encode()).hexdigest() if text else "", shared)
            for doc_id, n_a, n_b, n_groups, pairs, shared, text in docs]


@pytest.mark.parametrize("rows", SOURCES)
@pytest.mark.parametrize("frequent", [5, 200_000])
def test_alignment_counts(spark, rows, frequent):
    docs = documents(spark, rows)
    got = alignment.alignment_counts(docs, frequent=frequent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]
    assert listed(got.collect()) == listed(brute_alignment(docs.collect()))


def test_link_rows(spark):
    docs = documents(spark, hard_documents).withColumn("doc_id", F.monotonically_increasing_id())
    counts = {r.doc_id: r for r in alignment.alignment_counts(docs).collect()}
    over = alignment.link_rows(docs, "overlap").collect()
    group = alignment.link_rows(docs, "group").collect()
    assert {(r.doc_id, r.a_at, r.b_at) for r in over} <= {(r.doc_id, r.a_at, r.b_at) for r in group}
    assert Counter(r.doc_id for r in over) == {d: r.n_links for d, r in counts.items() if r.n_links}
    assert Counter(r.doc_id for r in group) == {d: r.n_shared for d, r in counts.items() if r.n_shared}


def test_row_products_equal_dense():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n, k, m = rng.integers(1, 9, 3)
        x, y = rng.integers(0, 3, (n, k)) * rng.integers(0, 2, (n, k)), rng.integers(0, 3, (k, m)) * rng.integers(0, 2, (k, m))

        def csr(d):
            return alignment.Csr(np.concatenate([[0], np.cumsum((d != 0).sum(1))]), np.nonzero(d)[1], d[d != 0])

        got, dense = alignment.row_products(csr(x), csr(y), int(m)), np.zeros((n, m), int)
        dense[got.rows(), got.indices] = got.data
        assert (dense == x @ y).all()


def test_queries(spark):
    counts = queries.op12_pre_token_counts(spark, SMALL)
    assert dict(counts.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    linked = queries.op13_byte_alignment(spark, SMALL)
    types = dict(linked.dtypes)
    assert types.pop("groups_sha256") == "string" and set(types.values()) == {"bigint"}
    assert counts.count() == linked.count() == table(spark, SMALL, "documents").count()
