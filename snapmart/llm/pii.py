"""Personal data: fixed patterns, extended by a skip-chain conditional random field.

Tokens that could belong to personal data are the nodes. A node has a potential from its shape, one
with the token beside it, and one with the next token in the document that repeats it or resembles
it (the same letters and digits, the same digits, the same mailbox). Loopy message passing carries
labels over these edges, so that a token far from the place that gives a value away is labelled like
it. Tokens in a pattern's span are observed; labels found elsewhere become further spans.

The weights are fitted here, piece by piece, on tokens of at most ``FIT_ROWS`` documents labelled by
the patterns: shapes by multinomial logistic regression, edges by how much oftener two labels meet
than by chance. Everything else sees all documents, each in one task and alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import documents

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
#: Documents the weights are fitted on, those with the smallest hashes.
FIT_ROWS = 1_000
SURE = 0.6
ROUNDS = 30
SKIP_STRENGTH = 6.0
#: Shapes of numbers that are no personal data; the fit sees each once in ``HARMLESS_EVERY`` texts.
HARMLESS = (
    "2024-01-31", "31.12.1999", "01/02/2003", "12:30:45", "1990-2000", "1998", "v1.2.3", "$1,299.00",
    "45%", "978-3-16-148410-0", "1.", "3.14", "A4", "2nd", "Q3-2021", "10-12", "1,000,000",
    "2001-09-11T08:46:40", "#123", "x86-64", "10.2.3.400", "999.1.2.3", "1.2.3.4567",
)
HARMLESS_EVERY = 50
#: Pairs of labels counted before any is seen; few pairs then say little.
SMOOTHING = 5.0

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_NUMBER = re.compile(r"[0-9]+")
_PART = re.compile(r"[0-9]{1,3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]\S*")
_WORD = re.compile(r"\S+")
_SIGNS = re.compile(r"[^0-9A-Za-z]+")

Span = tuple[int, int, int]  # start, end, kind
Span2 = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Found from the @ signs, so that a long run of letters is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1, start):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done, 0
        else:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))


def _addresses(text: str) -> Iterator[Span]:
    """Every four numbers of a run joined by single dots; each run is looked at once."""
    for run in _DOTTED.finditer(text):
        chain: list[tuple[int, int]] = []
        for number in _NUMBER.finditer(text, run.start(), run.end()):
            if chain and number.start() != chain[-1][1] + 1:
                chain = []
            chain.append(number.span())
            if len(chain) == 4:
                parts = [text[a:b].lstrip("0") for a, b in chain]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    yield chain[0][0], chain[3][1], 1
                chain = []


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns by start, then kind."""
    out: list[Span] = list(_emails(text)) if "@" in text else []
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((m.start(), m.end(), 3))
    if _NUMBER.search(text):
        out += _addresses(text)
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
    return sorted(out, key=lambda s: (s[0], s[2]))


def unsure_spans(text: str) -> list[Span2]:
    """Matches that were dropped although long enough, such as two numbers side by side: whether
    they hold personal data is not known, so the fit leaves their tokens out."""
    out = [m.span() for m in _PHONE.finditer(text) if sum(map(str.isdigit, m.group())) > 15]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if len(digits) >= 12 and not (len(digits) <= 19 and luhn(digits)):
            out.append(m.span())
    return sorted(out)


# Shapes of tokens. ----------------------------------------------------------------------------


def shape(token: str, before: str, after: str) -> list[float]:
    digits = "".join(c for c in token if c in "0123456789")
    n, dots = len(digits), token.count(".")
    core = token.strip(".,;:!?()[]\"'")
    letters = sum(c.isalpha() for c in token)
    at = token.find("@")
    parts = core.split(".")
    return [
        1.0, at >= 0, at > 0 and "." in token[at:], n == 0, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 11,
        12 <= n <= 19, n >= 20, dots == 0, dots == 1, dots == 2, dots == 3, dots >= 4,
        token.startswith("+"), "(" in token and ")" in token, "-" in token, letters > 0,
        letters == 0, core.isdigit(), 12 <= n <= 19 and luhn(digits),
        len(parts) == 4 and all(_PART.fullmatch(p) and int(p) <= 255 for p in parts),
        "=" in token, '"' in token, any(c.isupper() for c in token), len(token) > 24,
        before.startswith("+"), "(" in before, after.startswith("("), "-" in after,
    ]


def _alike(token: str) -> set[str]:
    """What a token shares with those that repeat or resemble it."""
    core = _SIGNS.sub("", token).lower()
    digits = "".join(c for c in token if c in "0123456789")
    out = {"t" + core} if len(core) >= 4 else set()
    if len(digits) >= 7:
        out.add("d" + digits)
    if len(_box(token)) >= 4:
        out.add("t" + _box(token))
    return out


@dataclass
class Graph:
    spans: list[tuple[int, int]]
    shapes: np.ndarray
    observed: np.ndarray  # kind of the pattern's span a token lies in, or NONE
    beside: np.ndarray  # pairs of neighbouring nodes
    skip: np.ndarray  # pairs of nodes that repeat or resemble each other


def _telling(text: str) -> list[Span2]:
    """Bounds of the words with a digit or @."""
    out = []
    for m in _SIGN.finditer(text):
        start = m.start()
        while start and not text[start - 1].isspace():
            start -= 1
        out.append((start, m.end()))
    return out


def _box(token: str) -> str:
    return _SIGNS.sub("", token.partition("@")[0]).lower()


def graph(text: str, base: list[Span]) -> Graph | None:
    """Nodes and edges of a document; None if it has no node."""
    spans = _telling(text)
    if not spans:
        return None
    # Words without digits take part if a mailbox is named like them.
    boxes = {_box(text[a:b]) for a, b in spans if "@" in text[a:b]}
    boxes = {b for b in boxes if len(b) >= 4}
    if boxes:
        named = {m.span() for m in _WORD.finditer(text) if _box(m.group()) in boxes}
        spans = sorted(named.union(spans))
    tokens = [text[a:b] for a, b in spans]
    observed = np.full(len(spans), NONE)
    k = 0
    for n, (start, end) in enumerate(spans):
        while k < len(base) and base[k][1] <= start:
            k += 1
        if k < len(base) and base[k][0] < end:
            observed[n] = base[k][2]
    near = [False, *(text[a[1] : b[0]].isspace() and b[0] - a[1] <= 2
                     for a, b in zip(spans, spans[1:])), False]
    shapes, beside, skip, last = [], [], set(), {}
    for n, token in enumerate(tokens):
        shapes.append(shape(token, tokens[n - 1] if near[n] else "", tokens[n + 1] if near[n + 1] else ""))
        if near[n]:
            beside.append((n - 1, n))
        for key in _alike(token):
            if key in last:
                skip.add((last[key], n))
            last[key] = n
    skip = sorted(skip.difference(beside))
    return Graph(
        spans, np.array(shapes, dtype=float), observed,
        np.array(beside, dtype=int).reshape(-1, 2), np.array(skip, dtype=int).reshape(-1, 2),
    )


# The field. -----------------------------------------------------------------------------------


@dataclass
class Model:
    weights: np.ndarray  # shape features x labels
    beside: np.ndarray  # labels x labels
    skip: np.ndarray


def _chance(pairs: np.ndarray, labels: int) -> np.ndarray:
    """Log of how much oftener two labels meet than by chance, smoothed."""
    counts = np.full((labels, labels), SMOOTHING)
    np.add.at(counts, (pairs[:, 0], pairs[:, 1]), 1)
    counts += counts.T
    share = counts / counts.sum()
    alone = share.sum(axis=0)
    return np.log(share) - np.log(alone)[:, None] - np.log(alone)[None, :]


def _sure(g: Graph, text: str) -> np.ndarray:
    """Nodes whose label the patterns tell."""
    unsure = unsure_spans(text)
    return np.array(
        [k != NONE or not any(a < e and s < b for s, e in unsure)
         for (a, b), k in zip(g.spans, g.observed, strict=True)], dtype=bool,
    )


def fit(texts: list[str], rounds: int = 300, rate: float = 2.0, decay: float = 1e-3) -> Model:
    """Weights from texts labelled by the patterns, each piece of the field on its own."""
    plain = [f"and {word} of" for word in HARMLESS] * (1 + len(texts) // HARMLESS_EVERY)
    graphs = [(g, _sure(g, t)) for t in texts if (g := graph(t, base_spans(t))) is not None]
    graphs += [(g, np.ones(len(g.spans), bool)) for t in plain if (g := graph(t, []))] if graphs else []
    labels = NONE + 1
    if not graphs:
        features = len(shape("", "", ""))
        return Model(np.zeros((features, labels)), np.zeros((labels, labels)), np.zeros((labels, labels)))
    x = np.concatenate([g.shapes[sure] for g, sure in graphs])
    y = np.eye(labels)[np.concatenate([g.observed[sure] for g, sure in graphs])]
    weights = np.zeros((x.shape[1], labels))
    for _ in range(rounds):
        score = x @ weights
        score = np.exp(score - score.max(axis=1, keepdims=True))
        score /= score.sum(axis=1, keepdims=True)
        weights -= rate * (x.T @ (score - y) / len(x) + decay * weights)
    pairs = {}
    for name in ("beside", "skip"):
        known = [(g, e[sure[e].all(axis=1)]) for g, sure in graphs for e in [getattr(g, name)]]
        pairs[name] = np.concatenate([g.observed[e].reshape(-1, 2) for g, e in known])
    skip = _chance(pairs["skip"], labels)
    skip[np.arange(NONE), np.arange(NONE)] = np.maximum(skip.diagonal()[:NONE], SKIP_STRENGTH)
    return Model(weights, _chance(pairs["beside"], labels), skip)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(g: Graph, model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of the nodes by loopy message passing over all edges."""
    own = g.shapes @ model.weights
    fixed = g.observed != NONE
    own[fixed] = -50.0
    own[fixed, g.observed[fixed]] = 0.0
    edges = np.concatenate([g.beside, g.skip])
    tables = np.concatenate(
        [np.repeat(model.beside[None], len(g.beside), 0), np.repeat(model.skip[None], len(g.skip), 0)]
    )
    # Every edge carries a message each way.
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    message = np.zeros((len(source), own.shape[1]))
    for _ in range(rounds if len(edges) else 0):
        belief = own.copy()
        np.add.at(belief, target, message)
        out = _log_sum((belief[source] - message[back])[:, :, None] + tables, 1)
        out -= _log_sum(out, 1)[:, None]
        out = 0.5 * out + 0.5 * message
        change = np.abs(out - message).max()
        message = out
        if change < 1e-3:
            break
    belief = own.copy()
    np.add.at(belief, target, message)
    return np.exp(belief - _log_sum(belief, 1)[:, None])


def all_spans(text: str, model: Model, sure: float = SURE) -> tuple[list[Span], list[Span]]:
    """Spans of the patterns, and these with those the field adds."""
    base = base_spans(text)
    g = graph(text, base)
    if g is None:
        return base, base
    own = g.shapes @ model.weights
    likely = own[:, :NONE].max(axis=1) > own[:, NONE] - 5
    if not base and not likely.any():
        return base, base
    chance = marginals(g, model)
    label = chance.argmax(axis=1)
    added = (label != NONE) & (chance.max(axis=1) >= sure) & (g.observed == NONE)
    more: list[Span] = []
    joined = {(a, b) for a, b in g.beside.tolist()}
    for n in np.flatnonzero(added):
        start, end = g.spans[n]
        # Marks around a value are no part of it.
        core = text[start:end].strip(".,;:!?[]\"'<>")
        start += text[start:end].find(core) if core else 0
        end = start + len(core)
        if more and n and added[n - 1] and label[n - 1] == label[n] and (n - 1, n) in joined:
            more[-1] = (more[-1][0], end, more[-1][2])
        elif core:
            more.append((start, end, int(label[n])))
    return base, sorted(base + more, key=lambda s: (s[0], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with every span, overlapping ones together, replaced by its kind in brackets."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def fitted(docs: DataFrame, text_col: str = "text", rows: int = FIT_ROWS) -> Model:
    """The model fitted on the ``rows`` different texts with a digit or @ whose hashes are
    smallest. The hashes are compared first, so that only those texts reach the driver."""
    some = docs.select(docs[text_col].cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    some = some.withColumn("h", F.xxhash64(F.lit("fit"), "text"))
    last = some.select("h").distinct().orderBy("h").limit(rows).agg(F.max("h").alias("h")).first()["h"]
    if last is None:
        return fit([])
    texts = some.where(F.col("h") <= last).dropDuplicates(["h"]).collect()
    return fit([r["text"] for r in sorted(texts, key=lambda r: r["h"])])


def _find(model: Model, sure: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                base, spans = all_spans(value.as_py() or "", model, sure)
                counts = [sum(k == s[2] for s in base) for k in range(NONE)]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts, digest, written(spans)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.record_batch(
                [batch.column("id"), *map(pa.array, columns, kinds)],
                names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    return run


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sure: float = SURE,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per document: the id, n_email, n_ip, n_card and n_phone (spans of the patterns),
    base_sha256 and spans (all of them, ``kind:start:end`` in code points).

    A null text is an empty one; every document is judged alone, so repeated rows, ties and null
    ids change nothing; other columns are not looked at; an empty table gives an empty result.
    """
    model = fitted(docs, text_col, fit_rows)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(
        _find(model, sure),
        f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
        " spans string",
    )
    return found.withColumnRenamed("id", id_col)


def redact(
    docs: DataFrame, text_col: str = "text", sure: float = SURE, fit_rows: int = FIT_ROWS
) -> DataFrame:
    """``docs``, all rows and columns, with every span in the text replaced by its kind in
    brackets. Null texts stay null; the other cases are as for ``find_personal_data``."""
    model = fitted(docs, text_col, fit_rows)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = []
            for value in batch.column(at):
                text = value.as_py()
                spans = all_spans(text, model, sure)[1] if text else []
                clean.append(redacted(text, spans) if spans else text)
            columns = [*batch.columns[:at], pa.array(clean, pa.string()), *batch.columns[at + 1 :]]
            yield pa.record_batch(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op10_skip_chain_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))
