"""SimHash, suffix arrays, decontamination, scoring and the pipeline against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from holdfast.llm import decontamination, packs, passages, scoring, simhash, suffixes
from holdfast.llm.components import components
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, print string, pack int"


@pytest.fixture(scope="module")
def docs(spark):
    """The table with NULL, empty, long and repeated texts, and columns named like the operators' own."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    base = table.filter("doc_id = 5").first().text
    odd = [
        (9001, None), (9002, ""), (9003, "é" * 80), (9004, "x" + "é" * 60), (9005, "a" * 500), (9006, "b" * 10 + "a" * 300 + "c"),
        (9007, base[:100] + "QQ" + base[100:300]), (9008, "ab" * 100), (9009, "z" + "ab" * 80), (9010, "x" * 49), (9011, "x" * 50),
        (9012, "x" * 50), (9013, " \n\t"), (9014, "one"), (9015, "w " * 40_000), (9016, base),
    ]
    rows = [(d, t, "en", "s", 0, "clash", 1) for d, t in odd]
    return table.select("*", F.lit("clash").alias("print"), F.lit(1).alias("pack")).unionByName(spark.createDataFrame(rows, SCHEMA))


@pytest.fixture
def small_packs(monkeypatch):
    monkeypatch.setattr(packs.dealt, "__defaults__", (100_000, False))
    monkeypatch.setattr(passages, "PACK", 100_000)


def _texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_fingerprints_and_components(docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.report(docs).collect()}
    prints = {d: brute.fingerprint(t) for d, t in _texts(docs).items()}
    classes = brute.components(prints)
    assert got == {d: (f"{prints[d]:016x}", classes[d]) for d in prints}


@pytest.mark.parametrize("light", [4, 64])
def test_links_of_a_dense_cluster(spark, light):
    rnd = random.Random(1)
    base, prints = rnd.getrandbits(64), set()
    for _ in range(400):
        x = base
        for b in rnd.sample(range(12), rnd.randint(0, 6)):
            x ^= 1 << (b * 5)
        prints.add(x)
    prints |= {rnd.getrandbits(64) for _ in range(100)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x), 0) for x in sorted(prints)], "print long, space int")
    root = {r.node: r.root for r in components(simhash.links(df, 2, 3, light).select("a", "b")).collect()}
    want = brute.components({signed(x): x for x in prints})
    assert {signed(x): root.get(signed(x), signed(x)) for x in prints} == want


def test_thresholds_add_up(spark):
    rnd = np.random.default_rng(2)
    x = rnd.integers(-(1 << 63), (1 << 63) - 1, 500)
    x[:300] &= 0xFFFF  # a skewed half: its other bits are all zero
    plan = simhash.Plan(spark.createDataFrame([(int(v), 0) for v in x], "print long, space int"), 4, 4)
    chosen = plan.thresholds(x)
    assert (chosen.sum(1) == 4 - 4 + 1).all() and chosen.min() >= -1 and len({tuple(c) for c in chosen}) > 1
    assert sorted(b for g in plan.groups for b in g) == list(range(64))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {n: got[n] for n in range(41)} == dict.fromkeys(range(41), 0)
    assert {n: got[n] for n in range(100, 160)} == dict.fromkeys(range(100, 160), 100) and got[300] == got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _word(rnd):
    return "".join(rnd.choices("abcdefghij", k=6))


@pytest.mark.parametrize("clash", [False, True])
def test_one_document_of_each_group_stays(docs, clash):
    rows = docs if clash else docs.select("doc_id", "text")
    texts = _texts(docs)
    classes = brute.components({d: brute.fingerprint(t) for d, t in texts.items()})
    kept = simhash.deduplicated(rows).collect()
    assert {r.doc_id: r.text for r in kept} == {d: texts[d] for d in set(classes.values())}
    assert len(kept) == len(set(classes.values())) < len(texts) and list(kept[0].asDict()) == rows.columns


@pytest.mark.parametrize("hot", [1000, 10])
def test_repeated_passages(docs, spark, small_packs, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT", hot)
    rnd = random.Random(5)
    often = "This passage of words stands in very many documents, all of them different."
    more = [(10_000 + i, f"{rnd.random()} {often} {rnd.random()}", "en", "s", 0, "", 1) for i in range(60)]
    docs = docs.unionByName(spark.createDataFrame(more, SCHEMA))
    got = {r.doc_id: tuple(r)[1:] for r in passages.report(docs).collect()}
    assert got == brute.substrings(_texts(docs))


def test_passages_without_identifier_or_rows(spark):
    text = "a passage that is certainly longer than fifty bytes in all"
    df = spark.createDataFrame([(None, text), (3, text), (3, text), (3, text + " and more"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in passages.report(df).collect())
    assert got == [(0, 0, 0), (0, 58, 58), (3, 58, 0), (3, 58, 0), (3, 67, 0)]
    assert passages.report(df.limit(0)).count() == 0
    assert passages.without_repeats(df.withColumn("n_chars", F.lit(1))).columns == ["doc_id", "text", "n_chars"]


def test_passages_of_other_texts_under_a_copys_identifier(spark):
    rnd = random.Random(10)
    said = [" ".join(_word(rnd) for _ in range(12)) for _ in range(5)]
    rows = [(1, said[0]), (None, said[0]), (None, said[1]), (None, said[2]), (2, said[3]), (7, said[3]), (7, said[4])]
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in passages.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = {(None, said[0]), (7, said[3])}
    want = set()
    for d, t in rows:
        kept = "" if (d, t) in gone else t
        want.add((d, len(t), len(t) - len(kept), hashlib.sha256(kept.encode()).hexdigest()))
    assert got == want


def test_suffix_arrays():
    rnd = random.Random(3)
    for _ in range(300):
        n, k = rnd.randint(1, 60), rnd.choice([1, 2, 3, 5])
        body = [rnd.randint(1, k) for _ in range(n)] if rnd.random() < 0.7 else [1, 2] * rnd.randint(1, 20) + [2] * rnd.randint(0, 9)
        t = np.array([*body, 0], np.uint8)
        raw = t.tobytes()
        sa = suffixes.suffix_array(t)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i, raw=raw: raw[i:])
        width = min(4, len(body))
        same = suffixes.common_prefixes(t, sa, np.array([0]), np.array([len(body) - width + 1]), width)
        for a, b in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True):
            if b <= len(body) - width:
                assert same[b] == next((i for i in range(width) if raw[a + i : a + i + 1] != raw[b + i : b + i + 1]), width)


@pytest.mark.parametrize("block", [8 << 20, 3000])
def test_decontamination(docs, spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    more = spark.createDataFrame([(900, "One"), (901, None), (902, ""), (900, "One"), (903, "no such words here at all in any document")], bench.schema)
    bench = bench.unionByName(more)
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = {r.doc_id: tuple(r)[1:6] for r in decontamination.report(docs, bench).collect()}
    want = {}
    for d, t in _texts(docs).items():
        n, hit, found = brute.contamination(t, items)
        want[d] = n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0
    assert got == want and sum(w[1] > 0 for w in want.values()) > 1
    kept = {r.doc_id for r in decontamination.decontaminated(docs, bench).collect()}
    assert kept == {d for d, w in want.items() if not w[1]}
    assert decontamination.report(docs.limit(0), bench).count() == 0
    assert decontamination.report(docs, bench.limit(0)).filter("contaminated").count() == 0


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_proximity_within_one_document(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rnd = random.Random(12)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = {i: " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 60))) for i in range(120)}
    texts |= {500: "x " * 40 + "alpha", 501: "beta gamma delta", 502: "alpha " + "y " * 18 + "beta Gamma", 503: "gamma " + "y " * 20 + "alpha beta", 504: None}
    items = [("near", "alpha beta gamma"), ("short", "alpha beta"), ("none", None), ("near", "delta zeta eta")]
    items += [(f"i{k}", " ".join(rnd.choices(vocabulary, k=6))) for k in range(15)]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_near, r.near_sha256) for r in decontamination.report(docs, spark.createDataFrame(items, "item_id string, text string")).collect()}
    want = brute.near_items(texts, items)
    assert got == {d: (len(x), hashlib.sha256(",".join(x).encode()).hexdigest()) for d, x in want.items()}
    assert want[500] == want[501] == want[503] == [] and want[502] == ["near"] and sum(map(len, want.values())) > 100


def test_rows_are_judged_by_identifier_and_text(spark):
    rnd = random.Random(9)
    text = [" ".join(_word(rnd) for _ in range(60)) for _ in range(6)]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (3, text[2]), (3, text[3]), (1, text[3]), (None, text[3]), (4, text[4]), (4, text[4]), (5, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id or 0, r.text) for r in simhash.deduplicated(df).collect()), key=str)
    want = [(0, text[0]), (0, text[1]), (3, text[2]), (1, text[3]), (4, text[4])]
    assert [x for x in kept if x[0] != 5] == sorted(want, key=str) and len(kept) == len(want) + 1
    bench = spark.createDataFrame([("a", text[0]), ("b", text[2])], "item_id string, text string")
    clean = decontamination.decontaminated(df, bench).collect()
    assert sorted(map(str, clean)) == sorted(str(r) for r in df.collect() if r.text not in (text[0], text[2]))


def test_scores(docs, small_packs):
    got = {r.doc_id: r for r in scoring.report(docs).collect()}
    tokens = {d: (t or "").encode().lower().split() + [b" end"] for d, t in _texts(docs).items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    c = Counter(w for d, t in tokens.items() if not held[d] for w in t)
    total, known = sum(c.values()), len(c)
    for d, t in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(t), sum(c[w] > 0 for w in t), total)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (total + known + 1)) for w in t))
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) and max(r.score for r in got.values()) < 0
    assert scoring.report(docs.limit(0)).count() == 0


def test_learned_weights_find_the_mixture():
    cells = np.array([(5 * scoring.BINS + 4) * scoring.BINS + 20, (5 * scoring.BINS + scoring.BINS - 1) * scoring.BINS + 20])
    w = scoring.learned(cells, np.array([900, 100]), 1 << 20)
    assert w[5, 0] > 0.8 and np.allclose(w.sum(1), 1) and w[0, 0] == 0


def test_pipeline_stages(spark, docs):
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars")
    seen = [rows.count()]
    assert [k for k, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows
        rows = stage(spark, rows, SF)
        if k < 4:
            assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            rows = spark.createDataFrame(rows.collect(), rows.schema)
            assert rows.join(before, "doc_id", "left_anti").count() == 0
            seen.append(rows.count())
    assert seen == sorted(seen, reverse=True) and seen[2] < seen[1] and rows.count() > 0
    assert {"doc_id", "text", "source", "copy", "size"} <= set(rows.columns)
