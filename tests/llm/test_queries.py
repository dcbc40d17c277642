"""The registered queries on the given tables, against SQL or plain versions, and the pipeline."""

import hashlib
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

import corpus_pipeline
from snapmart.llm import chat, packing, pii, sharding
from snapmart.llm.queries import QUERIES, SQL
from tests.compare import compare, duck
from tests.llm.helpers import empty, plain_bytes, plain_words, words
from tests.llm.test_selection import plain_kept, water
from tests.llm.test_simhash import plain_print, plain_roots
from tests.llm.test_text_operators import plain_spans

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def rows_of(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_names_and_numbers():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert all("LIMIT" not in s.replace("LIMIT 1)", "") and "SAMPLE" not in s.upper() for s in SQL.values())


def test_repeated_bytes(spark, documents):
    found = rows_of(spark, "op1_suffix_array_dedup")
    for d, want in zip(documents, plain_bytes([d[1] for d in documents], 400), strict=True):
        assert tuple(found[d[0]])[1:5] == want


def test_repeated_words(spark, documents):
    found = rows_of(spark, "op6_fm_index_dedup")
    for d, want in zip(documents, plain_words([d[1] for d in documents], 35), strict=True):
        assert tuple(found[d[0]])[1:4] == want


def test_near_duplicates(spark, documents):
    found = rows_of(spark, "op4_simhash_deletion_variants")
    prints = [plain_print(d[1]) for d in documents]
    for d, p, root in zip(documents, prints, plain_roots(prints), strict=True):
        assert tuple(found[d[0]])[1:] == (f"{p:016x}", documents[root][0])


def test_shards(spark, documents):
    found = rows_of(spark, "op5_hypergeometric_sharding")
    assert len(found) == len(documents)
    sizes = Counter(r["shard"] for r in found.values())
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert sorted(sizes.values()) == sorted(sharding.shard_sizes(len(documents), 16))
    for d in documents:
        data = (d[1] or "").encode()
        r = found[d[0]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    slots = defaultdict(set)
    for r in found.values():
        slots[r["shard"]].add(r["slot"])
    assert all(slots[s] == set(range(n)) for s, n in sizes.items())


def test_packed_documents(spark, documents):
    found = QUERIES["op9_sum_of_squares_packing"](spark, SF).collect()
    encode = packing.encoding(packing.vocabulary()).encode_ordinary
    tokens = {d[0]: len(encode(d[1] or "")) + 1 for d in documents}
    total = Counter()
    for r in found:
        total[r["doc_id"]] += r["length"]
    assert total == tokens
    used = len({r["sequence_id"] for r in found})
    assert used <= 1.02 * sum(tokens.values()) / 1024 + 1


def test_personal_data(spark, documents):
    found = rows_of(spark, "op10_skip_chain_crf")
    for d in documents:
        base, r = plain_spans(d[1] or ""), found[d[0]]
        counts = [sum(s[2] == k for s in base) for k in range(4)]
        assert [r[f"n_{k}"] for k in pii.KINDS] == counts
        assert r["base_sha256"] == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert {x for x in pii.written(base).split(",") if x} <= set(r["spans"].split(","))


def test_recovered_roles(spark, con):
    found = {r["conv_id"]: r for r in QUERIES["op7_transcript_hmm"](spark, SF).collect()}
    turns = con.execute("SELECT conv_id, turn, role, text FROM conversations ORDER BY ALL").fetchall()
    want = defaultdict(list)
    for c, _, role, text in turns:
        want[str(c)].append((role, text))
    assert set(found) == set(want)
    same = [c for c in want if found[c]["roles"] == ",".join(r for r, _ in want[c])]
    assert len(same) >= 0.8 * len(want)
    assert sum(found[c]["rendered"] == chat.rendered(want[c]) for c in same) >= 0.8 * len(same)


# The pipeline. --------------------------------------------------------------------------------


def plain_mix(rows):
    """Copies of each document, by running over every source in the order of its hashes."""
    by = defaultdict(list)
    for doc_id, text, source in rows:
        place = hashlib.md5(f"mix-7|{doc_id}|{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()
        by[source].append((place, len(words(text)), doc_id))
    names = sorted(by, key=lambda s: (s is None, s))
    sizes = [sum(x[1] for x in by[s]) for s in names]
    targets = water(sizes, [1 + i % 3 for i in range(len(names))], 3)
    copies = Counter()
    for source, size, target in zip(names, sizes, targets, strict=True):
        whole = min(3, int(target / size)) if size else 0
        need = target - whole * size if whole < 3 else 0
        upto, best, taken = 0, (need, 0), []
        for i, (_, n, _) in enumerate(sorted(by[source])):
            upto += n
            best = min(best, (abs(upto - need), i + 1))
        taken = sorted(by[source])[: best[1]] if need > 0 else []
        for _, _, d in by[source]:
            copies[d] += whole
        for _, _, d in taken:
            copies[d] += 1
    return +copies


def test_pipeline_agrees_with_a_plain_version(spark, documents):
    """Stage by stage: each stage's rows must be what its plain version makes of its input."""
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "personal_data", "mixture", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs
        assert name == "packing" or docs.columns == columns

    def read(name):
        return sorted((r.doc_id, r.text, r.source) for r in out[name].collect())

    kept = [d for d in documents if plain_kept(d[1])]
    assert read("quality_rules") == kept
    roots = plain_roots([plain_print(d[1]) for d in kept])
    single = [d for i, d in enumerate(kept) if roots[i] == i]
    assert read("near_duplicates") == single
    model = pii.fitted(out["near_duplicates"])
    clean = [(d, pii.redacted(t, pii.all_spans(t, model)[1]), s) for d, t, s in single]
    assert read("personal_data") == clean
    assert not any(plain_spans(t) for _, t, _ in clean)
    assert all(r.n_chars == len(r.text) for r in out["personal_data"].collect())
    assert Counter(d for d, _, _ in read("mixture")) == plain_mix(clean)
    encode = packing.encoding(packing.vocabulary()).encode_ordinary
    wanted, texts, found = Counter(), {d: t for d, t, _ in clean}, Counter()
    for d, n in plain_mix(clean).items():
        wanted[d] = n * (len(encode(texts[d])) + 1)
    pieces = out["packing"].collect()
    for r in pieces:
        found[r.doc_id] += r.length
    assert found == wanted
    assert len({r.sequence_id for r in pieces}) <= 1.02 * sum(wanted.values()) / 1024 + 1
    assert corpus_pipeline.run(spark, SF).count() == len(pieces)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables(spark, name, stage):
    assert stage(spark, empty(spark), SF).count() == 0
