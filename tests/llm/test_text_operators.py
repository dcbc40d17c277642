"""Personal data, chat transcripts, packing and top-k search."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapmart.llm import chat, packing, pii, topk_search
from tests.llm.helpers import COLUMNS, awkward, awkward_rows, empty, prose, sha

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text: str) -> list:
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= len(re.findall(r"\d", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.1-+ 9(é%25)", max_size=40))
def test_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_patterns_on_long_runs_are_quick():
    for text in ("a" * 300_000, "1" * 300_000, "+1" * 100_000, "a@" * 100_000, "1.." * 100_000):
        assert pii.base_spans(text) == []
    assert len(pii.base_spans("1." * 100_000)) == 25_000


PERSONAL = [
    "Mail mia.22@mail8.example.com now. Later mia.22 wrote, card 4539 1488 0343 6467 here.",
    "Call +1 (483) 555-1712 today, or 555-1712 in town; host 10.0.0.7 is up.",
    "+1 (269) 555-3296 4539148803436467 were both on the form",
    "Numbers like 1. and 2.5 and 2025-11-08 and 07.06.1987 and AKIAX7Y are nothing.",
]


@pytest.fixture(scope="module")
def model():
    texts = [f"{prose(i, 8)} u{i}x.{i}@mail{i % 9}.example.com {prose(i, 5)} +1 ({200 + i}) 555-{1000 + i} "
             f"{prose(i, 4)} 10.2.{i % 250}.7 {prose(i, 3)} 4539148803436467 {prose(i, 3)} {i}. k{i}=b{i}c"
             for i in range(150)]
    return pii.fit(texts)


def found(text, model):
    return [(pii.KINDS[k], text[a:b]) for a, b, k in pii.all_spans(text, model)[1]]


def test_the_field_adds_and_keeps(model):
    for text in PERSONAL:
        base, spans = pii.all_spans(text, model)
        assert base == pii.base_spans(text) and set(base) <= set(spans)
    assert ("email", "mia.22") in found(PERSONAL[0], model)
    assert ("phone", "555-1712") in found(PERSONAL[1], model)
    assert ("card", "4539148803436467") in found(PERSONAL[2], model)
    assert found(PERSONAL[3], model) == [] == found(prose(3, 200), model)


def test_consistency_comes_from_the_skip_edges(model):
    """Without them a bare mailbox is nothing."""
    alone = pii.Model(model.weights, model.beside, np.zeros_like(model.skip))
    assert ("email", "mia.22") not in found(PERSONAL[0], alone)


def card(rng):
    digits = [4, *rng.integers(0, 10, 14).tolist()]
    return next(t for d in range(10) if pii.luhn(t := "".join(map(str, [*digits, d]))))


def planted(seed):
    """A text, its values that no pattern finds as they stand, and nothing else that is personal."""
    rng = np.random.default_rng(seed)
    parts, truth, at = [], [], 0

    def put(text, kind=None):
        nonlocal at
        if kind is not None:
            truth.append((at, at + len(text), pii.KINDS.index(kind)))
        parts.append(text)
        at += len(text) + 1

    def talk(n):
        for word in prose(int(rng.integers(10**6)), n).split():
            put(word)

    user, end, four = f"{prose(seed, 1)}.{rng.integers(10, 99)}", rng.integers(1000, 9999), rng.integers(200, 999)
    harmless = [
        f"order {rng.integers(1000, 9999)}-{rng.integers(1000, 9999)}", f"on {rng.integers(1990, 2030)}-0{rng.integers(1, 9)}-11",
        f"for ${rng.integers(1, 99)},{rng.integers(100, 999)}.00", f"v{rng.integers(1, 9)}.{rng.integers(0, 20)}.1",
        f"at 1{rng.integers(0, 9)}:45", f"pages {rng.integers(10, 99)}-{rng.integers(100, 199)}", f"item {rng.integers(10**6, 10**7)}",
        f"release 10.2.{rng.integers(0, 9)}.{rng.integers(300, 999)}", f"x{rng.integers(10, 99)}.{rng.integers(10, 99)}",
    ]
    talk(6)
    if seed % 3 == 0:
        put(f"{user}@mail{seed % 7}.example.com")
        talk(9)
        put(user, "email")
        talk(4)
        put(user, "email")
    if seed % 3 == 1:
        put(f"+1 ({four}) 555-{end}")
        talk(7)
        put(f"555-{end}", "phone")
    if seed % 3 == 2:
        number = card(rng)
        put(f"card {number}")
        talk(5)
        put("both")
        put(f"+1 (212) 555-{end}", "phone")
        put(number, "card")
    talk(5)
    for text in rng.permutation(harmless)[:5]:
        put(str(text))
        talk(3)
    return " ".join(parts), truth


def measured(model, texts):
    """Precision and recall of what the field adds, spans exact."""
    hits = added = wanted = 0
    for text, truth in texts:
        base, spans = pii.all_spans(text, model)
        new, missing = set(spans) - set(base), set(truth) - set(base)
        hits, added, wanted = hits + len(new & missing), added + len(new), wanted + len(missing)
    return hits / max(added, 1), hits / wanted


def test_added_spans_against_planted_truth(model):
    """Measured: precision 1.00 and recall 0.99 of the added spans; recall 0.40 without skip edges."""
    texts = [planted(i) for i in range(300)]
    alone = pii.Model(model.weights, model.beside, np.zeros_like(model.skip))
    precision, recall = measured(model, texts)
    assert precision > 0.95 and recall > 0.95
    assert measured(alone, texts)[1] < 0.5


def test_dotted_numbers_beyond_255_are_no_addresses(model):
    assert pii.all_spans("digits of other kinds 1.2.3.\u00b2 and 1.2.3.\u0664", model)[0] == []
    for text in ("version 10.2.3.400 is out", "10.0.0.7 runs 10.0.0.700 and 10.0.300.7", "see 1.2.3.4567."):
        assert all(k != "ip" or x == "10.0.0.7" for k, x in found(text, model))


def test_message_passing_is_exact_on_a_chain():
    rng = np.random.default_rng(2)
    model = pii.Model(rng.normal(size=(4, 5)), rng.normal(size=(5, 5)), np.zeros((5, 5)))
    g = pii.Graph([(0, 1)] * 3, rng.normal(size=(3, 4)), np.array([4, 4, 4]), np.array([[0, 1], [1, 2]]),
                  np.zeros((0, 2), dtype=int))
    own, joint = g.shapes @ model.weights, {}
    for a in range(5):
        for b in range(5):
            for c in range(5):
                joint[a, b, c] = np.exp(own[0, a] + own[1, b] + own[2, c] + model.beside[a, b] + model.beside[b, c])
    total = sum(joint.values())
    want = [[sum(v for k, v in joint.items() if k[i] == x) / total for x in range(5)] for i in range(3)]
    assert np.allclose(pii.marginals(g, model, rounds=200), want, atol=2e-3)


def test_personal_data_of_tables(spark):
    rows = awkward_rows() + [(100 + i, t, "en", "a", 0) for i, t in enumerate(PERSONAL)]
    docs = spark.createDataFrame(rows, COLUMNS).withColumn("k1", F.lit(1)).withColumn("id", F.lit("x"))
    out = pii.find_personal_data(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        text = next(x[1] for x in rows if x[0] == r.doc_id) or "" if r.doc_id is not None else None
        if text is not None:
            base = plain_spans(text)
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in range(4)]
            assert r.base_sha256 == sha(pii.written(base).encode())
            assert set(pii.written(base).split(",")) <= set(r.spans.split(",")) or not base
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    texts = {r.doc_id: r.text for r in clean.collect() if r.doc_id is not None}
    assert texts[4] is None and "[CARD]" in texts[100]
    assert texts[1] == rows[0][1] and "@" not in texts[100]
    assert pii.find_personal_data(empty(spark)).count() == 0 == pii.redact(empty(spark)).count()


# Chat. ----------------------------------------------------------------------------------------


def conversations(spark, n=120):
    rng, rows = random.Random(4), []
    for c in range(n):
        roles = (["system"] if c % 3 == 0 else []) + ["user", "assistant"] * rng.randint(1, 4)
        for t, role in enumerate(roles):
            long_ = 60 if role == "assistant" else 10
            rows.append((c, t, role, "\n".join(prose(c * 50 + t * 7 + i, long_) + ("?" if role == "user" else ".") for i in range(2))))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_roles_are_recovered_on_held_out_conversations(spark):
    turns = conversations(spark)
    model = chat.fitted(turns.where("conv_id < 60"))
    held = turns.where("conv_id >= 60")
    got = {int(r.id): [(t.role, t.text) for t in r.turns] for r in chat.parse_segments(chat.transcripts(held), model).collect()}
    want = {}
    for r in sorted(held.collect()):
        want.setdefault(r.conv_id, []).append((r.role, r.text))
    right = sum(a == b for c in want for a, b in zip([x[0] for x in want[c]], [x[0] for x in got[c]], strict=False))
    assert right / sum(map(len, want.values())) > 0.9
    assert sum(got[c] == want[c] for c in want) / len(want) > 0.75


def test_segments_give_the_path_of_one_pass(spark):
    turns = conversations(spark, 40)
    model = chat.fitted(turns)
    whole = {r.id: [(t.role, t.text) for t in r.turns] for r in chat.parse_segments(chat.transcripts(turns), model).collect()}
    cut = {}
    for r in sorted(chat.parse_segments(chat.transcripts(turns, segment=2), model).collect(), key=lambda r: (r.id, r.segment)):
        said = cut.setdefault(r.id, [])
        for t in r.turns:
            if t.goes_on and said:
                said[-1] = (said[-1][0], (said[-1][1] + "\n" + t.text).strip("\n"))
            else:
                said.append((t.role, t.text))
    assert cut == whole


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    model = chat.Model(rng.normal(size=6), rng.normal(size=(6, 6)), [])
    shown = rng.normal(size=(4, 6))
    best, path = -np.inf, None
    for p in np.ndindex(6, 6, 6, 6):
        score = model.start[p[0]] + sum(shown[i, s] for i, s in enumerate(p)) + sum(model.step[a, b] for a, b in zip(p, p[1:]))
        if score > best:
            best, path = score, list(p)
    assert chat.viterbi(model, shown, model.start, None) == path
    first = (model.start + shown[0])[:, None] + chat.segment_table(model, shown[1:2])
    assert chat.cuts(model, [first, chat.segment_table(model, shown[2:])]) == [path[1], path[3]]


@pytest.mark.parametrize("line, role", [("User: hi", 1), ("### Assistant: x", 2), ("[system] x", 0), ("Q: x", 1),
                                        ("**Agent**: x", 2), ("SYS> x", 0), ("Another: x", 3), ("a cat", 3), ("", 3)])
def test_markers(line, role):
    assert chat.features(line, None)[0] == role


UNLISTED = (
    ("Moderator: ", "Alice: ", "Dr. Bob: "),
    ("[setup] ", "[guest] ", "[host] "),
    ("Scene> ", "P1> ", "P2> "),
    ("**Rules**: ", "**Interviewer**: ", "**Mary-Ann**: "),
)


def test_roles_are_recovered_behind_names_no_list_has(spark):
    """On a held-out fifth of sf0.1 0.91 of the turns and all roles of 0.81 of the conversations come
    out right; 0.28 and 0.09 if the names that recur are hidden from the model."""
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    turns = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL")
    held_out = F.pmod(F.xxhash64("conv_id"), F.lit(3)) == 0
    model, held = chat.fitted(turns.where(~held_out)), turns.where(held_out)
    want, got = {}, {}
    for r in sorted(held.select("conv_id", "turn", "role").distinct().collect()):
        want.setdefault(r.conv_id, []).append(r.role)
    for r in sorted(chat.parse_segments(chat.transcripts(held, styles=UNLISTED), model).collect()):
        got.setdefault(int(r.id), []).extend(t.role for t in r.turns)
    right = sum(a == b for c in want for a, b in zip(want[c], got[c], strict=False))
    assert right / sum(map(len, want.values())) > 0.8
    assert sum(got[c] == want[c] for c in want) / len(want) > 0.6


@pytest.mark.parametrize("line, name", [("Alice: hi", "alice"), ("Interviewer: so", "interviewer"), ("P1> yes", "p1"),
                                        ("[Dr. Bob] x", "dr. bob"), ("**Mary-Ann**: x", "mary-ann"), ("User: x", None),
                                        ("http://a", None), ("10:30 x", None), ("one two three four: x", None),
                                        ("so:much", None), ("", None)])
def test_names(line, name):
    assert chat.speaker(line) == name


def test_names_recur_over_segments(spark):
    lines = ["Ann: a", "Note: b", "Ben: c", "Ann: d", "User: e", "Ben: f", "User: g"]
    rows = [("x", i, t, None if i == 0 else lines[i - 1]) for i, t in enumerate(lines)] + [("y", 0, "Ann: a", None)]
    segments = spark.createDataFrame(rows, "id string, segment long, text string, before string")
    assert [tuple(r) for r in chat.speakers(segments).collect()] == [("x", ["ann", "ben"])]
    assert chat.recurring(lines) == ["ann", "ben"]
    assert chat.marker("Ben: c", ["ann", "ben"]) == (3, 3, 5)
    assert chat.marker("Note: b", ["ann", "ben"]) == (3, 1, 0)


def test_tables_are_combined_in_a_tree(spark):
    """One conversation of 70 segments, four at a time, against one pass over all of its tables."""
    rng = np.random.default_rng(3)
    model = chat.Model(rng.normal(size=6), rng.normal(size=(6, 6)), [])
    grids = {"long": rng.normal(size=(70, 6, 6)), "short": rng.normal(size=(3, 6, 6)), "odd": rng.normal(size=(17, 6, 6))}
    rows = [(k, i, g.ravel().tolist()) for k, gs in grids.items() for i, g in enumerate(gs)]
    tables = spark.createDataFrame(rows, "id string, segment long, table array<double>")
    found = {}
    for r in chat.segment_ends(tables, model, width=4).collect():
        found.setdefault(r.id, {})[r.segment] = r.leave
    for k, gs in grids.items():
        assert [found[k][i] for i in range(len(gs))] == chat.cuts(model, list(gs))


def test_segments_follow_each_other_over_gaps(spark):
    """Turn numbers with gaps: blocks are numbered and linked across windows of ``WIDTH`` blocks."""
    numbers = [0, 1, 2, 70, 71, 400, 9000, 9001]
    turns = spark.createDataFrame([(1, n, "user", f"t{n}") for n in numbers], "conv_id long, turn long, role string, text string")
    out = sorted(chat.transcripts(turns, segment=2).collect(), key=lambda r: r.segment)
    assert [r.segment for r in out] == [0, 1, 2, 3, 4]
    for a, b in zip(out, out[1:], strict=False):
        assert b.before == a.text.split("\n")[-1]
    assert out[0].before is None


def test_awkward_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 5, "assistant", None), (None, 1, "user", "a"),
            (2, None, None, "b"), (3, 900, "odd", "c\nd"), (None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("id", F.lit(1))
    out = chat.parse_segments(chat.transcripts(turns), chat.fitted(turns)).collect()
    assert Counter(r.id.startswith("row-") for r in out) == {True: 3, False: 2}
    none = turns.limit(0)
    assert chat.parse_segments(chat.transcripts(none), chat.fitted(none)).count() == 0
    assert chat.rendered([("user", "a"), ("assistant", "b")]) == "<|user|>\na\n<|end|>\n<|assistant|>\nb\n"


# Packing. -------------------------------------------------------------------------------------


def test_pieces_hold_the_tokens_of_the_public_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = awkward_rows() + [(50, "Tabs\tand\n\n  spaces, emoji 🙂 numbers 12345 don't", "en", "a", 0)]
    docs = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "doc_id long, text string")
    found = packing.pack_documents(docs, tokens=64, group_rows=20).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    for i, r in enumerate(rows):
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2], dtype="<u4")
        parts = sorted(by[i], key=lambda p: p.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert [p.length for p in parts[1:]] == [64] * (len(parts) - 1)
        assert len(parts) == -(-len(ids) // 64) and sum(p.length for p in parts) == len(ids)
        for p in parts:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]]
        assert sum(n for _, n in places) <= 64
    whole = packing.sequences(docs, tokens=64).collect()
    assert all(len(s.ids) == 4 * s.length for s in whole)
    assert sum(s.length for s in whole) == sum(r.length for r in found)


def plain_sum_of_squares(lengths, tokens):
    gaps, out = [], []
    for size in lengths:
        best, pick = None, None
        for i, g in enumerate(gaps):
            if g >= size:
                after = Counter(x for j, x in enumerate(gaps) if j != i and x > 0)
                if g > size:
                    after[g - size] += 1
                score = (sum(v * v for v in after.values()), g)
                if best is None or score < best[0]:
                    best = (score, i)
        pick = len(gaps) if best is None else best[1]
        if best is None:
            gaps.append(tokens)
        gaps[pick] -= size
        out.append(gaps[pick])
    return gaps


def test_the_rule_is_the_sum_of_squares():
    rng = random.Random(3)
    for order in (False, True):
        lengths = [rng.randint(1, 20) for _ in range(120)]
        lengths = sorted(lengths, reverse=True) if order else lengths
        sequence, offset = packing.sum_of_squares(np.array(lengths), 20)
        left = np.full(sequence.max() + 1, 20)
        for s, o, n in zip(sequence, offset, lengths, strict=True):
            assert o == 20 - left[s]
            left[s] -= n
        assert sorted(left) == sorted(plain_sum_of_squares(lengths, 20))


def test_few_sequences_are_used():
    lengths = np.sort(np.random.default_rng(0).integers(1, 1025, 5000))[::-1]
    sequence, _ = packing.sum_of_squares(lengths)
    assert sequence.max() + 1 <= 1.02 * lengths.sum() / 1024


def test_added_tokens_in_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = [f"hello {mark} world", mark, mark * 3, f"a  {mark}  b\n{mark}\n\nc", f"<|{mark}|>", "<|endoftext"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in packing.pack_documents(docs, with_ids=True).collect()}
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], dtype="<u4")
        assert bytes(found[i]["ids"]) == ids.tobytes()
        assert (found[i].length, found[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_packing_awkward_rows(spark):
    docs = awkward(spark)
    assert packing.pack_documents(docs).select("doc_id", "piece").count() >= len(awkward_rows())
    assert packing.pack_documents(empty(spark)).count() == 0


# Search. --------------------------------------------------------------------------------------


def plain_top(rows, k):
    usable = [(i, np.floor(np.array(v, dtype=np.float64) * 1024).astype(int)) for i, v in rows
              if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in usable:
        if q is None or q % 100:
            continue
        scores = []
        for i, b in usable:
            if i != q:
                n = min(len(a), len(b))
                scores.append((-int(a[:n] @ b[:n]), i is None, i))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out |= {(q, rank + 1, i, -s) for rank, (s, _, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("cells", [24 * 40, topk_search.MAX_SHARD_CELLS])
def test_top_k_is_exact(spark, cells, monkeypatch):
    monkeypatch.setattr(topk_search, "MIN_SHARD_CELLS", cells)
    monkeypatch.setattr(topk_search, "MAX_SHARD_CELLS", cells)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=24) * 0.2 + (i % 4) * 0.1)]) for i in range(350)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)]  # ties
    rows += [(400, None), (500, [0.1, None]), (501, [float("nan")] * 24), (502, [float("inf")] * 24),
             (None, rows[5][1]), (600, []), (700, [0.5, -0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).repartition(4)
    found = topk_search.top_k(frame, frame.where("vec_id % 100 = 0"), k=10)
    assert {tuple(r) for r in found.collect()} == plain_top(rows, 10)
    assert topk_search.top_k(frame.limit(0), frame.limit(0)).count() == 0
    assert topk_search.top_k(frame.limit(0), frame).count() == 0


def test_equal_query_rows_are_one_query(spark, monkeypatch):
    """A query that stands twice gets each hit once; other vectors of its id are other queries."""
    monkeypatch.setattr(topk_search, "MIN_SHARD_CELLS", 2)
    rows = [(i, [float(i), 1.0]) for i in range(1, 30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame(
        [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [-1.0, 0.0])], frame.schema
    )
    found = topk_search.top_k(frame, asked, k=3, scale=1).orderBy("rank", "vec_id")
    assert [tuple(r) for r in found.collect()] == [
        (100, 1, 1, -1), (100, 1, 29, 29), (100, 2, 2, -2), (100, 2, 28, 28), (100, 3, 3, -3), (100, 3, 27, 27),
    ]


def test_essential_terms_follow_the_threshold_and_no_hit_is_lost(monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 256)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 64))
    vectors = np.floor((centres[rng.integers(0, 8, 3000)] + 0.1 * rng.normal(size=(3000, 64))) * 100).astype(np.int64)
    shard, whole = topk_search.Shard(np.arange(3000), vectors), vectors.size

    def work(q, threshold=None):
        shard.traversed = shard.probed = 0
        ids, scores = shard.top(q, vectors[q], 10, threshold)
        return ids, scores, shard.traversed, shard.probed

    for q in (0, 7, 2999):
        ids, scores, traversed, probed = work(q)
        exact = vectors @ vectors[q]
        exact[q] = -(10**15)
        want = np.lexsort((np.arange(3000), -exact))[:10]
        assert (ids == want).all() and (scores == exact[want]).all()
        # All terms are essential in the first block only.
        assert 256 * 64 < traversed < whole * 0.6 and traversed + probed < whole * 0.7
        again = work(q, int(scores[-1]))  # handed in, as from another shard
        assert (again[0] == want).all() and again[2] < traversed
        assert work(q, int(np.abs(vectors).max() ** 2 * 64 + 1))[2:] == (0, 0)  # no term is essential
