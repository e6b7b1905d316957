"""Licenses, personal data, severity, near duplicates and shards against
brute-force versions and held-out rows."""

from __future__ import annotations

import itertools
import random
import re
import zlib

import numpy as np
import pytest

from odd import empty_documents, odd_documents
from tillroll.llm import licenses, near_dup, pii, sharding, toxicity
from tillroll.llm.common import table
from tillroll.llm.components import components

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


# ---------------------------------------------------------------- licenses

SIGN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def brute_marked(text):
    """Words with one blank around each, and a comma before the blanks that
    stand for a list separator, a line break or a sentence's end."""
    out, run = "", ""
    for c in " " + text.translate(LOWER) + " ":
        if SIGN.match(c):
            run += c
        else:
            out, run = out + blank(run) + c, ""
    return out + blank(run)


def blank(run):
    ends = any(a in ".!?" and b in " \t" for a, b in zip(run, run[1:]))
    return "" if not run else ", " if ends or set(run) & set(",;/|&+\n\r") else " "


def brute_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    line, starts, base = brute_marked(text or ""), [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        own = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += own
        base |= {label} if own else set()
    found = []
    for r in licenses.rules():
        for m in re.finditer(f"(?<= ){r.pattern}(?=,? )", line):
            a = line[:m.start()].count(" ") - 1
            found.append((a, a + m.group().count(" ") + 1, r))
    order = sorted(found, key=lambda d: (min(x[2].priority for x in found if d[0] <= x[0] and x[1] <= d[1]),
                                         d[0] - d[1], d[2].priority, d[0]))
    keep = []
    for d in order:
        if all(d[1] <= k[0] or k[1] <= d[0] for k in keep):
            keep.append(d)
    keep.sort(key=lambda d: d[:2])
    score = max([1.0] * bool(starts) + [d[2].confidence for d in keep] + [0.0])
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {d[2].label for d in keep})), score, [(d[0], d[1], d[2].label) for d in keep])


def test_hundreds_of_rules_stand_on_their_keyword():
    rules = licenses.rules()
    assert len(rules) > 400 and sum(r.priority < 500 for r in rules) > 180
    assert len({r.priority for r in rules}) == len(rules)
    gate = re.compile(licenses.gate_pattern(rules, licenses.BASE))
    assert all(re.compile(r.pattern) and gate.search(f" {r.keyword} ") for r in rules)
    assert all(r.keyword in r.pattern.replace(",? ", " ") for r in rules if r.priority < 500)


# headers and lists with the labels that a reader finds in them
HEADERS = [
    ("Licensed under the MIT License, BSD License", "bsd,mit"),
    ("ISC License, BSD License", "bsd,isc"),
    ("Licensed under the ISC License, BSD License, Zlib License", "bsd,isc,zlib"),
    ("MIT License / Apache License", "apache,mit"),
    ("MIT License\nBSD License\nISC License", "bsd,isc,mit"),
    ("Mozilla Public License; Eclipse Public License & Boost Software License", "boost,epl,mpl"),
    ("CC BY-SA 4.0, CC BY-NC 4.0", "cc-by,cc-by-nc,cc-by-sa"),
    ("Under the terms of the GNU Lesser General Public License, version 2.1", "lgpl"),
    ("GPL v2, LGPL v3 + AGPL v3", "agpl,gpl,lgpl"),
    ("released under the 3-clause BSD License", "bsd-3"),
    ("two clause BSD license | zlib license", "bsd-2,zlib"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("// SPDX-License-Identifier: Apache-2.0\n", "apache"),
    ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3"),
    ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", "cc-by,cc-by-nc-sa"),
    ("SPDX-License-Identifier: MPL-2.0", "mpl"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software", "boost"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:", "bsd"),
    ("Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS", "apache"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("This file has been put into the public domain.", "public-domain"),
    ("The Software shall be used for Good, not Evil.", "json"),
    ("Altered source versions must be plainly marked as such", "zlib"),
    ("You may distribute this program under the same terms as Perl itself", "artistic"),
    ("This Font Software is licensed under the SIL Open Font License, Version 1.1", "ofl"),
    ("Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements", "apache"),
    ("This program is distributed in the hope that it will be useful", "gpl"),
    ("This library is distributed in the hope that it will be useful", "lgpl"),
    ("All rights reserved", "proprietary"),
    ("do not reproduce. License: Business Source License", "bsl"),
    ("See LICENSE. ISC License applies", "isc"),
    ("dual licensed under the Apache License, Version 2.0 or MIT License", "apache,mit"),
    ("a text about the common law of permissions", ""),
]


def test_headers_and_lists(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HEADERS)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    wrong = {HEADERS[i][0]: (got[i], HEADERS[i][1]) for i in got if got[i] != HEADERS[i][1]}
    assert not wrong


def test_licenses_equal_brute_force(spark):
    made = [
        "MIT License mit license CC-BY cc by", "Licensed under the GNU General Public License, version 3. Apache License",
        "x cc by-nc-sa 4.0 is licensed under the Apache License, Version 2.0 GPL v2 license gpl v3", "éMIT license",
        "permission is hereby granted free of charge to any person obtaining a copy; all rights reserved. Copyright (c) 2020",
        "the gnu lesser general public license version 2 1 or bsd 3 clause license", "cc by cc by cc by",
        "license mit license bsd license isc license " * 20, ",\n;MIT License.\tBSD, license", "-" * 3000 + "mit license" + "." * 3000,
    ] + [t for t, _ in HEADERS]
    rng = random.Random(8)
    parts = ["mit", "license", "bsd", "isc", "gpl", "v2", "2.0", ",", "\n", "/", ". ", "under the", "licensed", "apache", "3 clause", "cc by", "public",
             "general", "gnu", "the"]
    made += [" ".join(rng.choice(parts) for _ in range(rng.randint(3, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(100 + i, t) for i, t in enumerate(made)], "doc_id long, text string").unionByName(
        odd_documents(spark).select("doc_id", "text")).unionByName(table(spark, SMALL, "documents").select("doc_id", "text"))
    for name in ("row", "words", "d", "marked", "run"):  # names the operator uses itself
        docs = docs.withColumn(name, docs.doc_id)
    got = sorted(((r.doc_id or 0), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score,
                  [(d.start, d.end, d.label) for d in r.detections]) for r in licenses.scan(docs).collect())
    want = sorted((r.doc_id or 0, *brute_licenses(r.text)) for r in docs.collect())
    key = lambda r: tuple(-1 if v is None else v for v in r[:5])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert licenses.scan(empty_documents(spark)).count() == 0


def test_license_plan_has_no_python(spark):
    plan = licenses.scan(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ----------------------------------------------------------- personal data

def brute_spans(text):
    luhn = lambda d: sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        out += [(2, *m.span())] if 13 <= len(digits) <= 19 and luhn(digits) else []
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.findall("[0-9]", m.group())) <= 15]


def test_base_spans_equal_plain_expressions():
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choice("ab.@-%+01 2()9é") for _ in range(rng.randint(1, 60)))
        assert pii.base_spans(text) == brute_spans(text)
    pii.base_spans("1" * 200_000 + "a" * 200_000 + "@" + "1." * 100_000)  # linear in long runs


def test_field_adds_and_keeps(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = pii.train(docs)
    text = "call +1 (017) 555-7713 or mail ann.1@mail3.example.com or 10.2.3.4 and 4111 1111 1111 1111; version 2.0"
    spans = pii.find_all([text, "nothing here", ""], model)
    assert [s[:3] for s in spans[0] if s[3]] == brute_spans(text) and spans[1:] == [[], []]
    swallowed = "Wort +1 (826) 555-4081 190.137.2.44 und"  # too many digits for the base pattern
    assert any(k == 3 and not base for k, _, _, base in pii.find_all([swallowed], model)[0])
    clean = [r.text for r in docs.filter(~docs.text.rlike("[0-9@]")).limit(50).collect()]
    assert not any(pii.find_all(clean, model))
    assert pii.redacted(text, spans[0]) == "call [phone] or mail [email] or [ip] and [card]; version 2.0"


def test_skip_edges_spread_a_label():
    graph = pii.Graph()
    graph.add(0, "x 5557713999 far away from y 5557713999 and 12", [(3, 2, 12)])
    assert graph.skip == [(0, 1)] and graph.label == [3, pii.CLEAR, pii.CLEAR]
    agree = np.eye(pii.CLEAR + 1) * 6
    near = pii.Field({1: 0}, np.zeros((1, pii.CLEAR + 1)), np.zeros_like(agree), agree).posteriors(graph)
    assert near[1].argmax() == 3 and near[1, 3] > 0.9 and abs(near[2] - 0.2).max() < 1e-9


def random_field(rng, facts):
    states = pii.CLEAR + 1
    return pii.Field({f: i for i, f in enumerate(facts)}, rng.normal(size=(len(facts), states)), rng.normal(size=(states, states)),
                     np.eye(states) * 1.5)


def enumerated(model, graph):
    """Posteriors by summing over all labellings."""
    score = model.scores(graph)
    n, states = score.shape
    total = np.zeros((n, states))
    for labels in itertools.product(range(states), repeat=n):
        if any(g != pii.CLEAR and g != own for g, own in zip(graph.label, labels)):
            continue
        known = [g != pii.CLEAR for g in graph.label]
        weight = sum(score[i, own] for i, own in enumerate(labels) if not known[i])
        weight += sum(model.chain[labels[a], labels[b]] for a, b in graph.chain) + sum(model.skip[labels[a], labels[b]] for a, b in graph.skip)
        for i, own in enumerate(labels):
            total[i, own] += np.exp(weight)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("text,spans,exact", [
    ("11 22 33 44", [], True),                      # a chain
    ("77 and far 88 99 and far 77", [], True),      # a chain and a skip edge, no loop
    ("77 and far 88 99 and far 77", [(3, 0, 2)], True),
    ("77 88 77 99", [], False),                     # a loop
])
def test_posteriors_equal_enumeration(text, spans, exact):
    graph = pii.Graph()
    graph.add(0, text, spans)
    assert graph.chain or graph.skip
    for seed in range(5):
        rng = np.random.default_rng(seed)
        model = random_field(rng, sorted({f for facts in graph.facts for f in facts})[:12])
        assert np.abs(model.posteriors(graph) - enumerated(model, graph)).max() < (1e-3 if exact else 0.15)


def test_posteriors_do_not_depend_on_the_batch():
    batch = ["11 22 33 44 11", "nothing", "5557713999 far from 5557713999 and 7713999 12 13 14 15 16 17", "1", "7 8 7 9 8 7 8 9"]
    graph = pii.Graph()
    for i, text in enumerate(batch):
        graph.add(i, text, [])
    model = random_field(np.random.default_rng(2), sorted({f for facts in graph.facts for f in facts}))
    whole = model.posteriors(graph)
    for i, text in enumerate(batch):
        alone = pii.Graph()
        alone.add(0, text, [])
        if alone.doc:
            assert (model.posteriors(alone) == whole[np.array(graph.doc) == i]).all()


def test_one_long_table_does_not_fill_the_sample(spark):
    table_of_numbers = " | ".join(str(10_000 + i) for i in range(4000))
    rows = [(0, table_of_numbers)] + [(i, f"write to user{i}@mail{i % 7}.example.com or call +1 (201) 555-{1000 + i}") for i in range(1, 900)]
    for doc_id in (0, 17, 4242):  # wherever the long text stands in hash order
        docs = spark.createDataFrame([(doc_id + 10_000 if i == 0 else i, t) for i, t in rows], "doc_id long, text string")
        assert pii.train(docs, sample_nodes=2000, rounds=20).facts


def test_personal_data_edges(spark):
    docs = odd_documents(spark)
    model = pii.train(docs)
    found = pii.digests(pii.find(docs, model)).filter("doc_id = 9").first()
    assert (found.n_email, found.n_ip, found.n_card, found.n_phone) == (1, 0, 1, 0)
    clean = pii.redact(docs, model)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert clean.filter("doc_id = 1").first().text is None
    empty = empty_documents(spark)
    assert pii.find(empty, pii.train(empty)).count() == 0


# ---------------------------------------------------------------- severity

def test_severity_on_held_out_rows(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    fit = labels.filter("doc_id % 4 <> 0")
    model = toxicity.train(docs, fit)
    held = toxicity.severities(docs, model).join(labels.filter("doc_id % 4 = 0"), "doc_id").toPandas()
    toxic = held["toxic"] == 1
    assert (held["rejected"] & toxic).sum() / toxic.sum() > 0.85
    assert (held["rejected"] & ~toxic).sum() / (~toxic).sum() < 0.02
    assert held[toxic]["severity"].mean() > 10 * held[~toxic]["severity"].mean()


def test_cumulative_fit_orders_thresholds():
    rng = np.random.default_rng(0)
    x = rng.exponential(1, (400, 1))
    grade = np.digitize(x[:, 0] + rng.normal(0, 0.1, 400), [0.5, 1.0, 2.0])
    w, t = toxicity.fit_cumulative(x, grade, 4)
    assert w[0] > 0 and (np.diff(t) > 0).all()


def test_words_with_inner_stars_count(spark):
    words = toxicity.words_of("sh*t f**k b**ch ab a*b sh*ts, clean")
    assert words == ["sh*t", "f**k", "b**ch", "ab", "a*b", "sh*ts", "clean"]
    known = {"sh*t", "sh**", "f**k", "f***", "b**ch", "ab", "a*b", "cle*"}
    want = {"sh*t": 1, "sh**": 2, "f**k": 1, "f***": 1, "b**ch": 1, "ab": 1, "a*b": 1, "cle*": 1}
    assert toxicity._counter(known)(words) == want
    rows = [(i, f"some plain words about weather number {i} " + "sh*t f**k " * (i % 2)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    got = toxicity.severities(docs, toxicity.train(docs, labels)).collect()
    assert all(r.rejected == bool(r.doc_id % 2) for r in got)


def test_severity_edges(spark):
    docs, none = odd_documents(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    blank = toxicity.train(docs, none)
    assert toxicity.severities(docs, blank).filter("rejected").count() == 0
    assert toxicity.reject_toxic(docs, blank).exceptAll(docs).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None), (99, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, odd).cut > 1
    assert toxicity.severities(empty_documents(spark), toxicity.train(empty_documents(spark), odd)).count() == 0


# --------------------------------------------------------- near duplicates

def brute_components(rows, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(d, len(s), rows[root(i)][0], rows[root(i)][0] == d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(spark, percent):
    rng = random.Random(7)
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").orderBy("doc_id").collect()]
    base = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    for i in range(60):  # a crowd of near copies
        copy = list(base)
        for _ in range(rng.randint(0, 10)):
            copy[rng.randrange(300)] = f"x{rng.randint(0, 9999)}"
        rows.append((10_000 + i, " ".join(copy)))
    rows += [(20_000, "one two"), (20_001, "One  two"), (20_002, ""), (20_003, None), (20_004, "two one")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, a long")
    got = sorted(map(tuple, near_dup.near_duplicates(docs, percent=percent).collect()))
    assert got == sorted(brute_components(rows, percent))


@pytest.mark.parametrize("percent,changed", [(80, 3), (85, 2)])
def test_one_original_with_many_copies_equals_brute_force(spark, percent, changed):
    """Copies are linked with the original alone: each replaces other words."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(154)]
    rows = [(500, " ".join(base))]
    for i in range(1200):
        copy = list(base)
        for at in rng.sample(range(154), changed + (i % 40 == 0) * 12):
            copy[at] = f"x{i}y{at}"
        rows.append((1000 + i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_dup.near_duplicates(docs, percent=percent).collect()))
    assert got == sorted(brute_components(rows, percent))


def test_near_duplicate_edges(spark):
    got = near_dup.near_duplicates(odd_documents(spark)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.component_id, r.kept))
    assert len(got) == 12 and by[3] == [(3, True)] and by[4] == [(3, False)]
    assert by[6] == [(6, True)] * 2 and by[1] == [(1, True)] and by[None] == [(None, False)]
    assert near_dup.near_duplicates(empty_documents(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    links = [(a, b) for a, b in zip(order, order[1:])] + [(1000, 1001), (1001, 1000), (1002, 1002)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**{i: 0 for i in range(200)}, 1000: 1000, 1001: 1000}


# ------------------------------------------------------------------ shards

@pytest.mark.parametrize("bits,dims", [(2, 2), (3, 3), (2, 4)])
def test_hilbert_curve_steps_to_neighbours(bits, dims):
    grid = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = sharding.hilbert_index(grid, bits)
    assert sorted(index) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("rows", [odd_documents, empty_documents, None])
def test_shards(spark, rows):
    docs = rows(spark) if rows else table(spark, SMALL, "documents")
    got = sharding.hilbert_shards(docs).collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == want
    slots = [sorted(r.slot for r in got if r.shard == s) for s in range(8)]
    assert all(s == list(range(len(s))) for s in slots)
    assert max(map(len, slots)) - min(map(len, slots)) <= 1


def test_written_shards_prune(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    sharding.write_shards(docs, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.select(docs.columns).exceptAll(docs).count() == 0 and back.count() == docs.count()
    sources = back.groupBy("_shard").agg({"source": "approx_count_distinct"}).toPandas().iloc[:, 1]
    assert sources.mean() < 0.8 * docs.select("source").distinct().count()


def far_sources(spark, n=4000, sources=200):
    """Sources that differ only after a long common beginning; one holds a third
    of the rows, some are null."""
    rng = random.Random(3)
    name = lambda i: f"https://crawl.example.org/segments/{i:05d}"
    rows = [(i, f"text {i}", "en", None if i % 97 == 0 else name(0 if rng.random() < 0.33 else rng.randrange(sources)), rng.randrange(5000))
            for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_string_bounds_are_exact_quantiles(spark):
    docs = far_sources(spark)
    for parts in (4, 32):
        got = sharding.string_bounds(docs.repartition(5), ["source", "lang"], parts)
        ordered = sorted(r.source for r in docs.collect() if r.source is not None)
        want = [ordered[-(-len(ordered) * i // parts) - 1] for i in range(1, parts)]
        assert got == {"source": list(dict.fromkeys(want)), "lang": ["en"]}
    assert sharding.string_bounds(docs.limit(0), ["source"], 8) == {"source": []}


def test_slots_follow_the_curve(spark):
    docs = far_sources(spark)
    got = sharding.hilbert_shards(docs, keep=["source", "lang", "n_chars"]).collect()
    bounds = {"lang": ["en"], **sharding.string_bounds(docs, ["source"], 32)}
    sizes = sorted(r.n_chars for r in docs.collect())
    assert max(r.curve for r in got) < 2**15
    ordered = [(r.curve, r.doc_id) for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)
    # a row's place is that of its cells; numbers are cut at quantiles good to one part in 10,000
    place = lambda r: [sum(b <= r.kept[d] for b in bounds[d]) if r.kept[d] is not None else 0 for d in ("lang", "source")]
    cells = {}
    for r in got:
        cells.setdefault(r.curve, set()).add(tuple(place(r)))
    assert all(len(c) == 1 for c in cells.values())
    for r in got:
        rank = np.searchsorted(sizes, r.kept.n_chars) / len(sizes)
        options = [min(31, max(0, int(rank * 32) + k)) for k in (-1, 0, 1)]
        assert r.curve in sharding.hilbert_index(np.array([[*place(r), o] for o in options]), 5)


def test_sources_with_a_common_beginning_prune(spark):
    docs = far_sources(spark)
    of = {}
    for r in sharding.hilbert_shards(docs, dimensions=("source", "n_chars"), keep=["source"]).collect():
        of.setdefault(r.shard, set()).add(r.kept.source)
    assert np.mean([len(s) for s in of.values()]) < 0.5 * 200
