"""The Merkle manifest against a plain recursive version and the query's SQL."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from oracle_check import duck
from odd import ODD_SCHEMA, empty_documents, odd_documents
from tillroll.llm import manifest, queries
from tillroll.llm.common import table

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return sha("".join(map(field, [row.doc_id, row.source, row.lang, row.n_chars, text])))


def brute(nodes, fanout):
    """Top of the tree over ``nodes`` and each node's (left, right) siblings."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for i, place in enumerate(at):
            run, slot = runs[place // fanout], place % fanout
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[i] = place // fanout
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def expected(rows, fanout=8):
    trees = {}
    for r in rows:
        trees.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda x: x[:3])
        built[lang] = brute([x[2] for x in trees[lang]], fanout)
    root, tops = brute([built[lang][0] for lang in order], fanout) if order else (None, [])
    out = []
    for lang, top in zip(order, tops):
        subroot, paths = built[lang]
        for (_, _, own, r), path in zip(trees[lang], paths):
            path, text = path + top, r.text
            if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r, text)
            for left, right in path:
                folded = sha(left + folded + right)
            proof = sha("".join(a + b for a, b in path))
            out.append((r.doc_id, own, subroot, root, proof, folded, folded == root))
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def uneven(spark):
    """Trees of 1, 2, 9, 65 and no language at all, with ids in no order."""
    sizes = {"aa": 1, "é": 2, "zz": 9, "en": 65, None: 3}
    rows = [((i * 37) % 101, f"Text {lang} {i}", lang, None if i % 3 else "S", i, 1, 2, 3)
            for lang, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, ODD_SCHEMA)


@pytest.mark.parametrize("rows", [odd_documents, empty_documents, uneven, None])
@pytest.mark.parametrize("fanout", [8, 3])
def test_manifest_equals_recursion(spark, rows, fanout):
    docs = rows(spark) if rows else table(spark, SMALL, "documents")
    for name in ("tree", "pos", "digest", "claimed", "path"):  # names the operator uses itself
        docs = docs.withColumn(name, F.lit(7))
    got = manifest.audit(docs, manifest.lowered_where_third(docs), fanout)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    assert got == expected(docs.collect(), fanout)


def test_partitions_do_not_change_the_root(spark):
    docs = uneven(spark)
    roots = [manifest.prove(docs.repartition(n)).select("root").distinct().collect() for n in (1, 7)]
    assert roots[0] == roots[1] and len(roots[0]) == 1


def test_query_and_sql(spark):
    got = sorted(map(tuple, queries.op11_slot_pivot_manifest(spark, SMALL).collect()))
    assert got == sorted(duck(SMALL).execute(queries.oracle_sql()["op11_slot_pivot_manifest"]).fetchall())
