"""Personal data in texts: base patterns and a skip-chain conditional random field.

Base spans (email, ip, card, phone) are the leftmost non-overlapping matches of
fixed expressions, kept if they pass a check; they always stay.

The field's nodes are the words that hold a digit or an @; all other words are
clear. Its labels are the kinds and ``clear``. Potentials: each node's shape and
neighbouring words; a chain between neighbouring nodes; and skip edges between a
node and the last one before it with the same signs, or the same last digits,
wherever it stands in the document. Weights come from a pseudo-likelihood fit to
base spans in a bounded sample (``sample_nodes`` nodes, those of the smallest
hashes of id and place, so that no text fills it before its share). Loopy
sum-product messages over all nodes of a text make repeated tokens agree; a node outside base spans whose posterior of a kind reaches
``least`` becomes a span of it, neighbours of one kind together.

Edge cases: null and empty texts have no spans; offsets are code points, ends
exclusive; without base spans in the sample nothing is added; nodes and edges
grow with the text, so very long texts cost in proportion; repeated rows are each
searched; extra columns pass through ``redact`` untouched.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, texts

KINDS = ("email", "ip", "card", "phone")
CLEAR = len(KINDS)
SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>"
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# the same matches as the plain expressions, without their retries inside a run
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NODE = re.compile(r"(?<!\S)\S*[0-9@]\S*")

Span = tuple[int, int, int]


def _luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return sum(values[::2] + [sum(divmod(2 * v, 10)) for v in values[1::2]]) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the base patterns, by kind and start."""
    out: list[Span] = []
    last = 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        if m.start() < last:
            continue
        head = text[last:m.start()]
        local = len(head) - len(head.rstrip(_LOCAL))
        if local:
            out.append((0, m.start() - local, m.end()))
            last = m.end()
        else:
            last = m.start() + 1
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# ------------------------------------------------------------------ the field

def _bucket(n: int, steps: tuple[int, ...]) -> int:
    return sum(n >= s for s in steps)


def _features(core: str, before: str, after: str) -> list[int]:
    digits = sum(c.isdigit() for c in core)
    letters = sum(c.isalpha() for c in core)
    facts = [
        f"d{_bucket(digits, (1, 2, 4, 7, 9, 13, 20))}", f"l{_bucket(letters, (1, 3, 8, 20))}", f"dots{min(core.count('.'), 4)}",
        f"dash{min(core.count('-'), 2)}", f"at{core.count('@') == 1}", f"plus{core[:1] == '+'}", f"paren{'(' in core}",
        f"shape{re.sub('(9+|a+)', lambda m: m.group()[0], ''.join('9' if c.isdigit() else 'a' if c.isalpha() else c for c in core[:40]))[:16]}",
        f"size{digits}x{_bucket(letters, (1, 4))}x{core.count('.')}", f"b{before[-12:].lower()}", f"a{after[:3].lower()}",
    ]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in facts]


@dataclass
class Graph:
    """Nodes of texts in a row, with their chain and skip edges (earlier, later)."""

    doc: list[int] = field(default_factory=list)
    span: list[tuple[int, int]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    facts: list[list[int]] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)

    def add(self, doc: int, text: str, spans: list[Span]) -> None:
        """Nodes of one text, labelled by the base spans they meet."""
        if not ("@" in text or _DIGIT.search(text)):
            return
        by_start = sorted((a, b, k) for k, a, b in spans)
        at = 0
        last_of: dict[str, int] = {}
        previous, previous_end = -1, -1
        for m in _NODE.finditer(text):
            a, b = m.span()
            while a < b and not (text[a].isalnum() or text[a] in "+("):
                a += 1
            while b > a and not (text[b - 1].isalnum() or text[b - 1] == ")"):
                b -= 1
            if a == b:
                continue
            while at < len(by_start) and by_start[at][1] <= a:
                at += 1
            label = CLEAR
            for s, e, k in by_start[at:at + len(KINDS)]:
                if s < b and e > a:
                    label = k
                    break
            node, core = len(self.doc), text[a:b]
            before = text[max(0, m.start() - 24):m.start()].split()
            after = text[m.end():m.end() + 24].split()
            self.doc.append(doc), self.span.append((a, b)), self.label.append(label)
            self.facts.append(_features(core, before[-1] if before else "", after[0] if after else ""))
            if previous >= 0 and text[previous_end:m.start()].isspace() and m.start() - previous_end <= 2:
                self.chain.append((previous, node))
            signs = "".join(c for c in core.lower() if c.isalnum())
            digits = "".join(c for c in signs if c.isdigit())
            keys = {"=" + signs} | ({"7" + digits[-7:]} if len(digits) >= 7 else set())
            chained = {previous} if self.chain and self.chain[-1] == (previous, node) else set()
            self.skip += [(other, node) for other in {last_of[k] for k in keys if k in last_of} - chained]
            last_of.update(dict.fromkeys(keys, node))
            previous, previous_end = node, m.end()


@dataclass(frozen=True)
class Field:
    """Weights of features, chain and skip edges; ``least`` posterior to add."""

    facts: dict[int, int] = field(default_factory=dict)
    unary: np.ndarray = field(default_factory=lambda: np.zeros((0, CLEAR + 1)))
    chain: np.ndarray = field(default_factory=lambda: np.zeros((CLEAR + 1, CLEAR + 1)))
    skip: np.ndarray = field(default_factory=lambda: np.zeros((CLEAR + 1, CLEAR + 1)))
    least: float = 0.95

    def scores(self, graph: Graph) -> np.ndarray:
        out = np.zeros((len(graph.doc), CLEAR + 1))
        for i, facts in enumerate(graph.facts):
            at = [self.facts[f] for f in facts if f in self.facts]
            if at:
                out[i] = self.unary[at].sum(axis=0)
        return out

    def posteriors(self, graph: Graph, rounds: int = 30) -> np.ndarray:
        """Loopy sum-product: both directions of every edge at once, damped. Each
        text stops by itself, so its posteriors are the same in any batch."""
        score = self.scores(graph)
        known = np.array(graph.label) != CLEAR  # base spans are given
        score[known] = -30.0
        score[known, np.array(graph.label)[known]] = 0.0
        edges = np.array(graph.chain + graph.skip, np.int64).reshape(-1, 2)
        if len(edges):
            pots = np.concatenate([np.repeat(self.chain[None], len(graph.chain), 0), np.repeat(self.skip[None], len(graph.skip), 0)])
            source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
            pots = np.concatenate([pots, pots.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(edges), 2 * len(edges)), np.arange(len(edges))])
            message = np.zeros((2 * len(edges), CLEAR + 1))
            of = np.unique(np.array(graph.doc), return_inverse=True)[1][source]
            live = np.arange(len(message))  # edges of texts that still move
            for _ in range(rounds):
                belief = score.copy()
                np.add.at(belief, target[live], message[live])
                new = _logsum((belief[source[live]] - message[back[live]])[:, :, None] + pots[live], 1)
                new = 0.5 * message[live] + 0.5 * (new - _logsum(new, 1)[:, None])
                moved = np.zeros(of.max() + 1)
                np.maximum.at(moved, of[live], np.abs(new - message[live]).max(axis=1))
                message[live] = new
                live = live[moved[of[live]] >= 1e-4]
                if not len(live):
                    break
            np.add.at(score, target, message)
        return np.exp(score - _logsum(score, 1)[:, None])


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(docs: DataFrame, sample_nodes: int = 6000, rounds: int = 300, l2: float = 1.0, least: float = 0.95) -> Field:
    """Pseudo-likelihood fit (every node given its neighbours' labels) to the
    base spans of ``sample_nodes`` nodes; nodes are made on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            graph = Graph()
            for i, text in enumerate(batch["text"].to_pylist()):
                graph.add(i, text, base_spans(text))
            near = np.zeros((3, len(graph.doc), CLEAR + 1), np.int32)
            label = np.array(graph.label, np.int64)
            for k, edges in ((0, graph.chain), (2, graph.skip)):
                for a, b in edges:
                    near[k, b, label[a]] += 1
                    near[k + 1 if k == 0 else k, a, label[b]] += 1
            ids = batch["doc_id"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[d] for d in graph.doc], pa.int64()), pa.array([a for a, _ in graph.span], pa.int32()),
                 pa.array(label, pa.int32()), pa.array(graph.facts, pa.list_(pa.int64())),
                 pa.array(list(near.transpose(1, 0, 2).reshape(len(graph.doc), 3 * (CLEAR + 1))), pa.list_(pa.int32()))],
                ["doc_id", "start", "label", "facts", "near"])

    nodes = texts(docs).mapInArrow(run, "doc_id long, start int, label int, facts array<long>, near array<int>")
    # stored first: the executors merge their smallest, the driver gets the sample alone
    rows = materialize(nodes.orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start", "label").limit(sample_nodes), "nodes").collect()
    y = np.array([r["label"] for r in rows], np.int64)
    if not (y != CLEAR).any():
        return Field(least=least)
    found, often = np.unique(np.array([f for r in rows for f in r["facts"]]), return_counts=True)
    facts = {int(f): i for i, f in enumerate(found[often >= 3])}
    x = np.zeros((len(rows), len(facts)), np.float32)
    for i, r in enumerate(rows):
        x[i, [facts[f] for f in r["facts"] if f in facts]] = 1
    left, right, far = np.array([r["near"] for r in rows], float).reshape(len(rows), 3, CLEAR + 1).transpose(1, 0, 2)
    want = np.eye(CLEAR + 1)[y]
    params = [np.zeros((len(facts), CLEAR + 1)), np.zeros((CLEAR + 1,) * 2), np.zeros((CLEAR + 1,) * 2)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for i in range(1, rounds + 1):
        w, t, s = params
        score = x @ w + left @ t + right @ t.T + far @ s
        error = want - np.exp(score - _logsum(score, 1)[:, None])
        pull = far.T @ error
        grads = [x.T @ error, left.T @ error + (right.T @ error).T, (pull + pull.T) / 2]
        for j, (p, g) in enumerate(zip(params, grads)):
            g = (g - l2 * p) / len(rows)
            m[j], v[j] = 0.9 * m[j] + 0.1 * g, 0.999 * v[j] + 0.001 * g * g
            params[j] = p + 0.05 * (m[j] / (1 - 0.9 ** i)) / (np.sqrt(v[j] / (1 - 0.999 ** i)) + 1e-9)
    return Field(facts, *params, least)


def find_all(batch: list[str], model: Field) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, base) of every text, by kind and start."""
    base = [base_spans(t) for t in batch]
    out = [[(*s, True) for s in spans] for spans in base]
    graph = Graph()
    for i, (text, spans) in enumerate(zip(batch, base)):
        graph.add(i, text, spans)
    if not graph.doc or not model.facts:
        return out
    posterior = model.posteriors(graph)
    best = posterior[:, :CLEAR].argmax(axis=1)
    added = (np.array(graph.label) == CLEAR) & (posterior[np.arange(len(best)), best] >= model.least)
    joined = {b: a for a, b in graph.chain}
    open_span: dict[int, tuple[int, int, int]] = {}  # last node: where its span stands
    for node in np.flatnonzero(added).tolist():
        kind, (a, b), doc = int(best[node]), graph.span[node], graph.doc[node]
        before = open_span.pop(joined.get(node, -1), None)
        if before and out[doc][before[2]][0] == kind:
            place = before[2]
            out[doc][place] = (kind, out[doc][place][1], b, False)
        else:
            place = len(out[doc])
            out[doc].append((kind, a, b, False))
        open_span[node] = (kind, doc, place)
    return [sorted(spans) for spans in out]


def find(docs: DataFrame, model: Field) -> DataFrame:
    """``doc_id`` and all spans of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for batch in batches:
            found = find_all(batch["text"].to_pylist(), model)
            spans = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in s] for s in found]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, kind)], ["doc_id", "spans"])

    return texts(docs).mapInArrow(run, SPANS)


def digests(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their SHA-256, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redacted(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """The text with every span replaced by its kind in brackets (overlapping
    spans by the first one's)."""
    out, at = [], 0
    for kind, a, b in sorted(((k, a, b) for k, a, b, _ in spans), key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Field) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, ``n_chars`` (if there)
    recounted for texts that changed, other columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            old = batch["text"].to_pylist()
            found = find_all([t or "" for t in old], model)
            new = [redacted(t, s) if s else t for t, s in zip(old, found)]
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(new, batch.schema.field("text").type)
            if "n_chars" in names:
                n = batch["n_chars"].to_pylist()
                columns[names.index("n_chars")] = pa.array(
                    [len(t) if s else c for t, s, c in zip(new, found, n)], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
