"""License scan, quality rules and mixing against plain versions, over sf0.001 and hand-made rows."""

import random
import pytest
from pyspark.sql import functions as F

from holdfast.llm import licenses, mixing, quality, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "Under the MIT License. under the mit license"), (5, "CC-BY-NC 4.0 cc by nc"),
    (6, "Apache License, Version 2 apache license version 2 apache"), (7, "É under THE mit licensé"), (8, "a b c " * 3000),
    (9, "x\nx\n\n \nx y\nx"), (10, "# $ % word & | <tag>"), (11, "under the K mit license"), (4, "Under the MIT License. under the mit license"),
    (None, "one two three one two three four"), (12, "w" * 200_000), (13, "\U0001f600 é b  c"), (14, "cc by nc"), (15, "the"),
]


@pytest.fixture(scope="module")
def small(spark):
    rows = spark.createDataFrame([(d, t, "x", "en", 1) for d, t in ROWS], "doc_id long, text string, source string, hash string, pos int")
    return rows


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _docs(spark, small, name):
    return small.select("doc_id", "text") if name == "small" else spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.mark.parametrize("name", ["small", "sf"])
def test_license_base(spark, small, name):
    docs = _docs(spark, small, name)
    got = licenses.report(small if name == "small" else docs)
    want = [(r.doc_id, *brute.license_base(r.text, licenses.PHRASES)) for r in docs.collect()]
    assert _rows(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == sorted(want, key=str)
    assert got.filter("score < 0 or score > 1 or not (base_labels = '' or labels != '')").count() == 0


def test_repeated_fragments_are_no_license(spark):
    rows = [(1, "license version 2 " * 6), (2, "general public license " * 9), (3, "under the apache license " * 40), (4, "a copy of the license " * 30)]
    got = licenses.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.labels for r in got} == {""} and all(r.score < 0.6 for r in got)


def test_license_labels_and_scores(spark, small):
    rnd, rows = random.Random(2), [(r.doc_id, r.text) for r in small.collect()]
    rows += [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    for k, notice in enumerate([*licenses.NOTICES, *licenses.PHRASES] * 3):
        w = notice.split()
        for _ in range(rnd.randrange(6)):
            at = rnd.randrange(len(w))
            w[at : at + rnd.randrange(2)] = rnd.choice([[], ["x"], ["two", "words"], w[:4]])
        rows.append((10_000 + k, " ".join(["before"] * rnd.randrange(4) + w + w[: rnd.randrange(9)])))
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "n int, doc_id long, text string")
    got = licenses.report(df.select(F.col("n").cast("long").alias("doc_id"), "text")).collect()
    want = [brute.license_scan(t, licenses.NOTICES, licenses.PHRASES) for _, t in rows]
    assert [(r.labels, pytest.approx(r.score)) for r in sorted(got, key=lambda r: r.doc_id)] == want
    assert {"mit", "apache-2", "bsd", "isc"} <= {x for labels, _ in want for x in labels.split(",")}


def test_license_notice_with_changed_words(spark):
    text = "permission is hereby granted free of all charge to any person getting a copy of this software and associated documentation files to deal in the software"
    df = spark.createDataFrame([(1, text), (2, "permission granted to any person")], "doc_id long, text string")
    assert [(r.doc_id, r.labels) for r in licenses.report(df).orderBy("doc_id").collect()] == [(1, "mit"), (2, "")]


@pytest.mark.parametrize("name", ["small", "sf"])
def test_quality_measures(spark, small, name):
    docs = _docs(spark, small, name)
    got = quality.report(small if name == "small" else docs)
    want = [(r.doc_id, *brute.quality(r.text)) for r in docs.collect()]
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert _rows(got.select(*cols)) == sorted(want, key=str)
    assert got.filter("base_failed and kept").count() == 0


def test_cascade_does_not_depend_on_the_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs.filter(quality.cascade(list(o), F.col("text")).isNull()).select("doc_id") for o in (quality.RULES, quality.RULES[::-1])]
    assert _rows(kept[0]) == _rows(kept[1]) == _rows(quality.filtered(docs).select("doc_id"))


def test_mixing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    extra = spark.createDataFrame([(-1, None, "a b"), (-1, None, "a b"), (-2, "", None), (None, "zz", "c")], docs.schema)
    docs = docs.unionByName(extra)
    got = mixing.report(docs).collect()
    size = {}
    for r in docs.collect():
        size[r.source] = size.get(r.source, 0) + len(brute.SPACED.findall(r.text or ""))
    want = brute.targets(size)
    by = {r.doc_id: r.source for r in docs.collect()}
    taken = {}
    for r in got:
        s = by[r.doc_id]
        assert r.target == pytest.approx(want[s]) and r.source_size == size[s] and 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    largest = max(r.size for r in got)
    assert all(abs(taken[s] - want[s]) <= largest for s in size)
    assert _rows(mixing.report(docs)) == _rows(mixing.report(docs.repartition(5)))
    assert len(got) == docs.count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_twins(spark, name):
    from oracle import compare, connect

    assert compare(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name]) == []


def test_empty_tables(spark, small):
    none = small.limit(0)
    assert licenses.report(none).count() == quality.report(none).count() == mixing.report(none).count() == 0
