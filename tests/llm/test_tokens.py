"""Token files, packing and chunked encoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from odd import empty_documents, odd_documents
from tillroll.llm import bpe, chunks, packing, token_files
from tillroll.llm.common import materialize, table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    return bpe.load_tokenizer()


def library_ids(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def random_texts(n, seed=3):
    rng = random.Random(seed)
    signs = "ab'sdtrvelm  \n\t1²2é!.<|"
    return ["".join(rng.choice(signs) for _ in range(rng.randint(1, 4000))) for _ in range(n)]


def test_piece_encoder_equals_library(tok):
    texts = random_texts(80) + ["", " ", "'s", "a 's'll'x", "日本 x　y", "\U0001F600 b", "a<|endoftext|>b", "  a  "]
    got = bpe.PieceEncoder().encode(texts)
    assert [g.tolist() for g in got] == [library_ids(tok, t) for t in texts]


def test_known_pieces_are_numbers_alone(tok):
    enc = bpe.PieceEncoder()
    words = [f" {a}{b}q{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in map(chr, range(0x4E00, 0x4E00 + 600))]
    tracemalloc.start()
    try:
        got = sum(map(len, enc.encode(["".join(words)])))
        held = tracemalloc.get_traced_memory()[0] / len(words)
    finally:
        tracemalloc.stop()
    assert got > len(words) and held < 110  # about 200 with their texts in a dictionary


def test_pieces_learned_again_and_odd_ones(tok, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    monkeypatch.setattr(bpe, "LINES", 7)
    enc = bpe.PieceEncoder()
    texts = random_texts(30, seed=5) + ["   ", "\n\n\t", "a\x1cb \x1d", "\x85x\u2028y", "a\u0120b \u010a", "\ud800 x"[1:], "é" * 300]
    for part in (texts, texts[::-1], ["\n", " "], [texts[0]]):
        assert [g.tolist() for g in enc.encode(part)] == [library_ids(tok, t) for t in part]


def test_chunk_joins_are_exact(tok):
    texts = random_texts(40) + ["x" * 9000, "  " * 5000, "ab " * 4000, "日本 語 text " * 900]
    enc = chunks.ChunkEncoder(bpe.PieceEncoder())
    decoder = chunks.Decoder(enc.enc)
    for got, text in zip(enc.encode(texts), texts):
        assert got.tolist() == library_ids(tok, text)
        assert decoder.text(got) == tok.decode(got.tolist(), skip_special_tokens=False)
    shared = "".join(random_texts(20, seed=9))
    assert set(chunks.chunks("prefix " + shared)) & set(chunks.chunks(shared + " suffix"))


@pytest.mark.parametrize("rows", [odd_documents, empty_documents])
def test_encoded_documents(spark, tok, rows):
    docs = rows(spark)
    got = chunks.encode_documents(docs).collect()
    want = sorted((r.doc_id or 0, library_ids(tok, r.text)) for r in docs.collect())
    assert sorted((r.doc_id or 0, r.ids) for r in got) == want
    for r in got:
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(r.ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("rows", [odd_documents, empty_documents, None])
def test_token_files(spark, tok, tmp_path, rows):
    docs = rows(spark) if rows else table(spark, SMALL, "documents")
    token_files.write_token_files(docs, str(tmp_path / "t"), end_id=2)
    got = token_files.token_digests(token_files.read_token_files(spark, str(tmp_path / "t"))).collect()
    want, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id):
        ids = np.array(library_ids(tok, r.text) + [2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_file_layout(spark, tmp_path):
    token_files.write_token_files(table(spark, SMALL, "documents"), str(tmp_path / "t"))
    meta = pq.ParquetFile(next((tmp_path / "t").glob("part-*"))).metadata
    columns = {meta.row_group(0).column(i).path_in_schema.split(".")[0]: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids"].encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert columns["ids"].has_offset_index and columns["doc_id"].has_column_index
    files = token_files.read_token_files(spark, str(tmp_path / "t"))
    plan = files.filter("doc_id BETWEEN 5 AND 7").select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0] and "GreaterThanOrEqual(doc_id,5)" in plan


@pytest.mark.parametrize("rows", [odd_documents, empty_documents, None])
def test_packing(spark, tok, rows):
    docs = rows(spark) if rows else table(spark, SMALL, "documents")
    packed = packing.pack_documents(docs, group_pieces=32).toPandas()
    total = 0
    for _, s in packed.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 2048
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    left = sorted(tuple(-1 if v != v else int(v) for v in r) for r in packed[columns].itertuples(index=False, name=None))
    want = []
    for r in docs.collect():
        ids = np.array(library_ids(tok, r.text) + [0], "<u4")
        total += len(ids)
        cut = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        want += [(-1 if r.doc_id is None else r.doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                 for i, (a, b) in enumerate(zip(cut, cut[1:]))]
    assert left == sorted(want)
    if rows is None:  # small items: exchange reaches the bound of the whole
        assert packed["sequence_id"].nunique() == -(-total // 2048)


def random_pieces(spark, n, parts, low=1, high=2048):
    rng = np.random.default_rng(7)
    sizes = np.minimum(rng.geometric(1 / 700, n) + low, high - 1).tolist()
    rows = [(i, 0, 0, s, i, i) for i, s in enumerate(sizes)]
    cut = spark.createDataFrame(rows, packing.PIECES).repartition(parts)
    return sizes, materialize(cut.withColumn("unit", F.monotonically_increasing_id()))


@pytest.mark.parametrize("n", [600, 20_000])
def test_partitions_do_not_change_the_count(spark, n):
    seen = set()
    for parts in (1, 4, 32):
        sizes, cut = random_pieces(spark, n, parts)
        packed = packing.pack(cut, group_pieces=1000)
        row = packed.agg(F.count_distinct("sequence_id"), F.count(F.lit(1)), F.sum("length")).first()
        assert row[1:] == (n, sum(sizes))
        assert packed.filter("group_bins < group_bound").count() == 0
        seen.add(row[0])
    bound = packing.lower_bound(np.array(sizes), 2048)
    assert len(seen) == 1 and bound <= min(seen) <= bound * 1.001 + 1


def test_large_and_small_pieces_meet(spark):
    """Groups of large pieces need the small ones of others: bins of 2,048 from 1,500 + 548."""
    rows = [(i, 0, 0, 1500 if i < 300 else 137, i, i) for i in range(1500)]
    packed = packing.pack(materialize(spark.createDataFrame(rows, packing.PIECES)), group_pieces=40)
    assert packed.select("sequence_id").distinct().count() == 300


def test_exact_fill_and_tighten():
    rng = np.random.default_rng(4)
    for _ in range(100):
        sizes = np.sort(rng.integers(1, 200, rng.integers(1, 80)))[::-1].copy()
        bins, offsets, fill, bound = packing.pack_group(sizes, 256)
        assert bound <= len(fill) <= len(packing.best_fit(sizes, 256)[2]) and fill.max() <= 256
        for b in range(len(fill)):
            at = np.flatnonzero(bins == b)
            at = at[np.argsort(offsets[at])]
            assert offsets[at].tolist() == [0, *np.cumsum(sizes[at])[:-1]] and sizes[at].sum() == fill[b] > 0


def test_bounds_hold_and_certify():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes = rng.integers(1, 65, rng.integers(1, 60))
        bins, offsets, fill = packing.best_fit(sizes, 64)
        assert fill.max() <= 64 and fill.sum() == sizes.sum()
        assert packing.lower_bound(sizes, 64) <= len(fill)
    assert packing.lower_bound(np.array([33] * 10), 64) == 10
    assert packing.lower_bound(np.array([22] * 9), 64) == 5  # two fit, three do not


def test_pieces_can_carry_ids(spark):
    cut = materialize(packing.pieces(odd_documents(spark), capacity=64, with_ids=True))
    assert cut.filter("size(ids) <> length").count() == 0
