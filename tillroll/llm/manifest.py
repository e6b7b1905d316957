"""Merkle manifest of a corpus: leaves per document, a tree per language, one root.

A leaf is the SHA-256 of a row's fields. Within a language the leaves ascend by
``doc_id``; every ``fanout`` consecutive nodes become one, until one is left, the
language's subroot. The subroots, ordered by language, become the root alike.

The tree is built by a slot pivot. A node's place in its run is its *slot*; one
conditional aggregate per slot spreads the children of a parent into ``fanout``
columns of the parent's row. Joining those columns gives the parent's digest,
leaving out the own slot's column gives a child's siblings. Proofs run the other
way: a parent's row holds all its children, so a path of siblings is handed down
by one join a level with tables an eighth of the next one's size, and the leaves
come out of their parents' rows without a join of document-sized tables.

Places come from a range exchange on (language, doc_id, leaf), so a language with
a third of the rows is dealt over all tasks. Texts are read once; every later row
holds digests. Each level is stored under ``spark.checkpoint.dir``.

Edge cases: null fields are ``-`` in the leaf; rows without a language form the
first tree; rows without an id come first in theirs; repeated rows are leaves of
their own; equal ids are ordered by their leaf; empty and very long texts are
plain leaves; other columns are ignored, whatever their names; no rows: no proofs.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import materialize
from tillroll.operators.ranking import range_tagged

FANOUT = 8
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field in a leaf: ``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: dict[str, Column]) -> Column:
    """Leaf digest of the fields in their fixed order."""
    return digest(*[field(values[name]) for name in LEAF_FIELDS])


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def tree_key(lang: Column) -> Column:
    """A language as a key that is never null and keeps the order of trees:
    null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """One narrow row per document: ``tree``, ``doc_id``, ``digest`` (its leaf)
    and ``claimed`` (the leaf of the text that someone presents, by default the
    text itself; an expression over the columns of ``docs``)."""
    values = {name: F.col(name) for name in LEAF_FIELDS}
    shown = leaf(values | {"text": claimed}) if claimed is not None else leaf(values)
    return docs.select(
        tree_key(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf(values).alias("digest"), shown.alias("claimed"))


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, the place from 0 in the node's tree, and ``n``, the tree's
    nodes. Rows are dealt and sorted by (tree, order); what is summed up is one
    row per task and tree."""
    ranged = range_tagged(nodes, ["tree", *order])
    runs = ranged.groupBy("_tr_pid", "tree").agg(F.min("_tr_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_tr_pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_tr_pid", "tree", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(tree).alias("n"))
    return (ranged.join(runs, ["_tr_pid", "tree"]).withColumn("pos", F.col("_tr_pos") + F.col("_shift"))
            .drop("_tr_pid", "_tr_pos", "_shift"))


def _slots(fanout: int) -> list[str]:
    return [f"slot{i}" for i in range(fanout)]


def pivot_level(nodes: DataFrame, child: Sequence[str], fanout: int = FANOUT) -> DataFrame:
    """The parents of ``nodes`` (tree, pos, n, and the ``child`` columns, the
    digest first): one conditional aggregate per slot. Where a tree has one node
    left, it stays as it is."""
    slot, kid = F.col("pos") % fanout, F.struct(*child)
    return (
        nodes.groupBy("tree", F.floor(F.col("pos") / fanout).alias("up"), "n")
        .agg(*[F.max(F.when(slot == i, kid)).alias(name) for i, name in enumerate(_slots(fanout))])
        .select("tree", F.col("up").alias("pos"), "n", *_slots(fanout))
    )


def parent_nodes(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Digests of a pivoted level's rows, as the nodes of the next level."""
    joined = F.concat_ws("", *[F.col(f"{s}.digest") for s in _slots(fanout)])
    return level.select(
        "tree", "pos", F.ceil(F.col("n") / fanout).alias("n"),
        F.when(F.col("n") > 1, digest(joined)).otherwise(F.col("slot0.digest")).alias("digest"))


def build(nodes: DataFrame, payload: Sequence[str], label: str, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """All levels of the trees over numbered ``nodes``, the lowest first (its
    children carry ``payload`` beside the digest), and the trees' tops."""
    widest = nodes.agg(F.max("n")).first()[0] or 0
    levels, child = [], ["digest", *payload]
    while True:
        levels.append(materialize(pivot_level(nodes, child, fanout), f"{label}-{len(levels)}"))
        nodes, child, widest = parent_nodes(levels[-1], fanout), ["digest"], -(-widest // fanout)
        if widest <= 1:
            return levels, nodes.select("tree", "digest")


def hand_down(tops: DataFrame, levels: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """The lowest children with their ``path``: from the own level upwards, the
    siblings to the left and to the right of the node. ``tops`` holds tree, path
    and whatever else every child of the tree shall get."""
    shared = [c for c in tops.columns if c not in ("tree", "path")]
    rows = tops.withColumn("pos", F.lit(0).cast("long"))
    for level in reversed(levels):
        kids = F.array(*_slots(fanout))
        rows = rows.join(level, ["tree", "pos"]).select(
            "tree", "pos", "path", *shared, "n", F.transform(kids, lambda k: k["digest"]).alias("all"),
            F.posexplode(kids).alias("slot", "kid")).filter(F.col("kid").isNotNull())
        others = F.struct(
            F.array_join(F.slice("all", 1, F.col("slot")), "").alias("left"),
            F.array_join(F.slice("all", F.col("slot") + 2, fanout), "").alias("right"))
        path = F.when(F.col("n") > 1, F.concat(F.array(others), F.col("path"))).otherwise(F.col("path"))
        rows = rows.select("tree", (F.col("pos") * fanout + F.col("slot")).alias("pos"), path.alias("path"), *shared, "kid")
    return rows.select("tree", "pos", "path", *shared, "kid.*")


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along a path."""
    return F.aggregate(path, start, lambda node, at: digest(at["left"], node, at["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""))


def prove(docs: DataFrame, claimed: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """One row per document: ``doc_id``, ``leaf``, ``subroot``, ``root``, its
    ``path`` of siblings, and the ``claimed`` leaf (see ``leaves``)."""
    own = numbered(materialize(leaves(docs, claimed), "leaves"), ["doc_id", "digest"])
    levels, subroots = build(own, ["doc_id", "claimed"], "tree", fanout)
    subroots = materialize(subroots, "subroots")
    over = numbered(subroots.select(F.lit("").alias("tree"), "digest", F.col("tree").alias("of")), ["of"])
    upper, root = build(over, ["of"], "root", fanout)
    empty = F.array().cast("array<struct<left:string,right:string>>").alias("path")
    starts = hand_down(root.select("tree", empty, F.col("digest").alias("root")), upper, fanout)
    starts = starts.select(F.col("of").alias("tree"), "path", "root", F.col("digest").alias("subroot"))
    return hand_down(starts, levels, fanout).select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", "claimed")


def audit(docs: DataFrame, claimed: Column, fanout: int = FANOUT) -> DataFrame:
    """Every document's claim against the manifest: ``folded_root`` is what the
    claimed leaf and the true siblings give, ``verified`` whether it is the root."""
    return prove(docs, claimed, fanout).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("claimed"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered_where_third(docs: DataFrame) -> Column:
    """The tampered text of the registered query: A-Z lowered where 3 divides the
    CRC-32 of the decimal id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(chosen, lowered(F.col("text"))).otherwise(F.col("text"))


def _sql(levels: int = 9) -> str:
    """DuckDB SQL for the registered query; trees of up to 8^levels nodes."""
    def sql_field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def sql_leaf(text: str) -> str:
        return f"sha256({' || '.join(sql_field(text if f == 'text' else f) for f in LEAF_FIELDS)})"

    def up(to: str, source: str) -> str:
        return f"""{to} AS (SELECT tree, pos // 8 AS pos, (any_value(n) + 7) // 8 AS n, any_value(n) AS kids,
          string_agg(digest, '' ORDER BY pos) AS joined,
          CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE any_value(digest) END AS digest
          FROM {source} GROUP BY tree, pos // 8)"""

    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), "
           f"lambda c, k: {bit})), 4294967295::BIGINT)")
    tampered = f"CASE WHEN {crc} % 3 = 0 THEN translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}') ELSE text END"
    ctes = [
        f"""l AS (SELECT coalesce('=' || lang, '') AS tree, doc_id, {sql_leaf('text')} AS digest, {sql_leaf(f'({tampered})')} AS claimed
          FROM documents)""",
        """a0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
          count(*) OVER (PARTITION BY tree) AS n FROM l)""",
        *[up(f"a{i + 1}", f"a{i}") for i in range(levels)],
        f"""b0 AS (SELECT '' AS tree, tree AS of, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
          FROM a{levels})""",
        *[up(f"b{i + 1}", f"b{i}") for i in range(levels)],
    ]
    # d<i>: every document with its node at level i, the text of all siblings so far and the folded claim
    ctes.append("d0 AS (SELECT tree, doc_id, digest AS leaf, pos AS p, pos AS q, '' AS proof, claimed AS folded FROM a0)")

    def step(to: str, source: str, parent: str, own: str) -> str:
        cut = f"64 * ({own} % 8)"
        left, right = f"substr(u.joined, 1, {cut})", f"substr(u.joined, {cut} + 65)"
        return f"""{to} AS (SELECT d.* REPLACE ({own} // 8 AS {own.split('.')[1]},
          CASE WHEN u.kids > 1 THEN d.proof || {left} || {right} ELSE d.proof END AS proof,
          CASE WHEN u.kids > 1 THEN sha256({left} || d.folded || {right}) ELSE d.folded END AS folded)
          FROM {source} d JOIN {parent} u ON u.pos = {own} // 8 AND u.tree = """

    for i in range(levels):
        ctes.append(step(f"d{i + 1}", f"d{i}", f"a{i + 1}", "d.q") + "d.tree)")
    ctes.append(f"e0 AS (SELECT d.* EXCLUDE (p, q), b.digest AS subroot, b.pos AS q FROM d{levels} d JOIN b0 b ON b.of = d.tree)")
    for i in range(levels):
        ctes.append(step(f"e{i + 1}", f"e{i}", f"b{i + 1}", "d.q") + "'')")
    return f"""WITH {', '.join(ctes)}
      SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
        folded = r.digest AS verified FROM e{levels} CROSS JOIN b{levels} r"""


AUDIT_SQL = _sql()
