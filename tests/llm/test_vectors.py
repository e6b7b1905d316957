"""Exact and approximate vector search against brute force."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from tillroll.llm import queries, vectors
from tillroll.llm.common import table

SMALL = "/root/testdata/sf0.01"


def odd_vectors(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, [1.0, 2.0]), (0, [1.0, 1.5]), (1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, None), (4, []), (5, [None, 1.0]),
            (6, [inf, 1.0]), (7, [nan, 0.0]), (8, [0.0, 0.0]), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 0.5]), (None, [1.0, 1.0]),
            (50, [1.0, 2.0]), (100, [1.0, 2.0, 3.0])]
    return spark.createDataFrame([(a, b, 1, 2, 3) for a, b in rows], "vec_id long, embedding array<double>, tile int, block int, dim int")


def brute(rows, score, k=5):
    out = []
    for q, x in rows:
        if q % 50 == 0:
            found = sorted((-score(x, y), v) for v, y in rows if v != q and len(x) == len(y))[:k]
            out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(found)]
    return out


def test_exact_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    got = vectors.exact_top_k(table(spark, SMALL, "embeddings"), tile_rows=64, query_rows=4)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(queries.OP8_SQL).fetchall())


def test_exact_edges(spark):
    rows = [(0, [1.0, 1.5]), (1, [1.0, 2.0]), (2, [2.0, 4.0]), (8, [0.0, 0.0]), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 0.5]),
            (50, [1.0, 2.0]), (100, [1.0, 2.0, 3.0])]
    score = lambda x, y: sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x, y))
    assert sorted(map(tuple, vectors.exact_top_k(odd_vectors(spark)).collect())) == sorted(brute(rows, score))
    assert vectors.exact_top_k(odd_vectors(spark).limit(0)).count() == 0


def test_products_are_exact_beyond_doubles():
    a = np.array([[2.0**40, 1.0]])
    assert vectors._products(a, np.array([[2.0**20, 1.0]]))[0, 0] == 2**60 + 1


def test_forest_recall_and_scores(spark):
    rows = [(r.vec_id, np.array(r.embedding)) for r in table(spark, SMALL, "embeddings").collect()]
    got = vectors.forest_top_k(table(spark, SMALL, "embeddings")).collect()
    cosine = lambda x, y: float(x @ y / np.sqrt(x @ x) / np.sqrt(y @ y))
    want = brute(rows, cosine)
    by = dict(rows)
    assert all(abs(r.score - cosine(by[r.query_id], by[r.vec_id])) < 1e-12 for r in got)
    hits = {(r.query_id, r.vec_id) for r in got} & {(q, v) for q, _, v, _ in want}
    assert len(got) == len(want) and len(hits) / len(want) >= 0.9


def test_forest_edges(spark):
    got = vectors.forest_top_k(odd_vectors(spark), block_rows=2).collect()
    assert {r.query_id for r in got} == {0, 50, 100}
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: (r.query_id, r.rank)) if r.query_id == 50] == [(1, 1), (2, 2), (3, 0), (4, 10)]
    assert vectors.forest_top_k(odd_vectors(spark).limit(0)).count() == 0


@pytest.mark.parametrize("equal", [True, False])
def test_forest_leaves(equal):
    rng = np.random.default_rng(0)
    sample = np.ones((300, 4)) / 2 if equal else vectors._unit(rng.normal(size=(300, 4)))
    forest = vectors.Forest(sample, trees=3, leaf=16)
    for t in range(3):
        at = forest.leaf_of(sample, t)
        assert all((np.bincount(at, minlength=len(forest.leaf_rows)) == forest.leaf_rows) | (np.array(forest.leaf_tree) != t))


def clustered(n, clusters, seed=4):
    rng = np.random.default_rng(seed)
    centres = vectors._unit(rng.normal(size=(clusters, 16)))
    return centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, 16)) * 0.02


def test_a_stopped_search_loses_none_of_the_nearest():
    m = vectors._unit(clustered(3000, 60))
    forest = vectors.Forest(m, trees=4, leaf=16)
    at = [forest.leaf_of(m, t) for t in range(4)]
    shares = []
    for q in range(0, 3000, 60):
        nearest = np.sort(m @ m[q])[::-1]
        reach = math.sqrt(2 - 2 * nearest[5] + 1e-12)
        seen = np.isin(np.stack(at), forest.visits(m[q], math.inf, len(m), reach))
        assert seen.any(axis=0)[m @ m[q] >= nearest[5]].all()
        shares.append(seen.any(axis=0).mean())
    assert np.mean(shares) < 0.2  # of all rows


def test_clustered_vectors_are_found_and_repeats_count_once(spark):
    m = clustered(2000, 40)
    m[7], m[1999] = m[50], m[50]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    df = spark.createDataFrame([*rows, (7, [9.0, *m[7][1:].tolist()]), rows[50]], "vec_id long, embedding array<double>")
    got = vectors.forest_top_k(df, leaf=16, block_rows=32).collect()
    want = brute([(i, np.array(v)) for i, v in rows], lambda x, y: float(vectors.cosines(y[None], x)[0]))
    assert len(got) == len(want) and len({(r.query_id, r.vec_id) for r in got}) == len(got)
    assert {(r.query_id, r.vec_id): r.score for r in got}.keys() == {(q, v) for q, _, v, _ in want}
    assert all(abs(r.score - s) < 1e-15 for r, (_, _, _, s) in zip(sorted(got, key=lambda r: (r.query_id, r.rank)), sorted(want)))
    assert [(r.rank, r.vec_id) for r in got if r.query_id == 50 and r.rank < 3] == [(1, 7), (2, 1999)]


def test_near_keeps_the_best_of_each_query():
    rng = np.random.default_rng(1)
    a, b = vectors._unit(rng.normal(size=(300, 8))), vectors._unit(rng.normal(size=(500, 8)))
    query, row = vectors._near(a, b, 5)
    for i, x in enumerate(a):
        near = set(row[query == i].tolist())
        assert set(np.argsort(-(b @ x))[:6].tolist()) <= near and len(near) < 10
    assert [x.tolist() for x in vectors._near(a[:2], b[:3], 5)] == [[0, 0, 0, 1, 1, 1], [0, 1, 2] * 2]
    assert [len(x) for x in vectors._best_pairs(a[:1], np.array([9]), b[:1], np.array([9]), 5)] == [0, 0, 0]  # its own row alone
