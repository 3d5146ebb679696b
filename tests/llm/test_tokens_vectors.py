"""Tokenizer alignment, embedding near-dedup and whitening against plain versions."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from holdfast.llm import alignment, vectors, whitening
from holdfast.llm.queries import queries

F32 = "vec_id long, embedding array<float>, label int, node long, v string, z int"


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


# --- tokenizer alignment -------------------------------------------------------------

@pytest.fixture(scope="module")
def coders():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    with open(alignment.BYTE_BPE, "rb") as f:
        return a, b, alignment.byte_level_tokens(f.read()), alignment.piece_tokens(b)


def plain_alignment(rows, coders):
    """Per row what the contract returns, by loops over byte offsets."""
    a, b, bytes_a, bytes_b = coders
    docs, counts = [], Counter()
    for key, text in rows:
        groups, ia, ib = [], [], []
        if text:
            ia, ib = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
            whole = f" {text}".encode()
            if b"".join(bytes_a[t] for t in ia) != whole or b"".join(bytes_b[t] for t in ib) != whole:
                ia, ib = [], []
        ends = [set(np.cumsum([len(names[t]) for t in ids]).tolist()) for names, ids in ((bytes_a, ia), (bytes_b, ib))]
        for k, (names, ids) in enumerate(((bytes_a, ia), (bytes_b, ib))):
            at, part, cut = 0, [], []
            for t in ids:
                at += len(names[t])
                part.append(t)
                if at in ends[1 - k]:
                    cut.append(part)
                    part = []
            groups.append(cut)
        links = [(x[-1], y[-1]) for x, y in zip(*groups)]
        counts.update(links)
        docs.append((key, ia, ib, list(zip(*groups)), links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for key, ia, ib, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            key, len(ia), len(ib), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if ia else ""))
    return out


ODD = [
    (1, "plain words, and plain words"), (2, None), (3, ""), (4, " "), (5, "▁ already marked"), (6, "<|endoftext|> <s></s> <unk>"),
    (7, "naïve café 東京 🙂\n\n\tcode()  spaced   out"), (8, "a" * 5000 + " end"), (9, "\x00\x01 null"), (None, "no name"),
    (1, "plain words, and plain words"), (10, "  two  leading"), (11, "x\r\ny z​w"), (12, "word " * 30_000),
]


def test_alignment_of_odd_texts(spark, coders):
    docs = spark.createDataFrame([(k, t, "x", 1, 2) for k, t in ODD], "doc_id long, text string, pack string, pair int, n int")
    found = sorted((tuple(r) for r in alignment.report(docs, pack_bytes=2000).collect()), key=str)
    assert found == sorted(plain_alignment(ODD, coders), key=str)


def test_alignment_of_the_table(spark, small, coders):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    found = queries()["op11_tokenizer_alignment"](spark, small)
    assert sorted(map(tuple, found.collect())) == sorted(plain_alignment(rows, coders))


def test_alignment_groups_and_counts(spark, coders):
    docs = spark.createDataFrame([(1, "shared words shared words"), (2, None)], "doc_id long, text string")
    groups = by_id(alignment.groups(docs), "id")
    assert groups[2]["groups"] == []
    a, b, bytes_a, bytes_b = coders
    for g in groups[1]["groups"]:
        assert b"".join(bytes_a[t] for t in g["a"]) == b"".join(bytes_b[t] for t in g["b"])
    counts = alignment.pair_counts(docs).collect()
    assert sum(r["n"] for r in counts) == len(groups[1]["groups"])


def test_ranks_give_the_file_s_own_ids(spark, small, coders):
    with open(alignment.BYTE_BPE, "rb") as f:
        encode = alignment.byte_level_encoder(f.read(), coders[2])
    texts = [f" {r[0]}" for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect() if r[0]]
    texts += [f" {t}" for _, t in ODD if t]
    assert encode(texts) == [coders[0].encode(t, add_special_tokens=False).ids for t in texts]


def test_alignment_of_no_rows(spark):
    assert alignment.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# --- near copies of vectors ----------------------------------------------------------

def plain_links(rows, least=0.95):
    """(id, n_links, component_id, kept) by all pairs."""
    def ok(v):
        return v is not None and len(v) == 8 and all(c is not None and math.isfinite(c) for c in v) and any(v)

    n = len(rows)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok(v) else None for _, v in rows]
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and unit[i] @ unit[j] >= least]
            for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        root = min(ids, default=None)
        out.append((rows[i][0], len(near[i]), root, rows[i][0] == root))
    return out


def vector_rows():
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        rows += [(centre + rng.normal(size=8) * s).tolist() for s in (0.02, 0.1, 0.2, 0.3, 0.35, 0.4) for _ in range(6)]
    rows += [rows[0]] * 9 + [[2 * c for c in rows[0]]] + [[1.0] + [0.0] * 7, [-0.0, 1.0] + [0.0] * 6, [0.0, 1.0] + [0.0] * 6]
    rows += [[0.0] * 8, None, [], [1.0, None] + [0.0] * 6, [math.nan] + [1.0] * 7, [math.inf] + [1.0] * 7, [1.0, 2.0]]
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in enumerate(rows)]
    return rows + [(None, rows[3][1]), (3, rows[3][1]), (7, rows[200][1])]


@pytest.mark.parametrize("tile_rows", [20, 10_000])
def test_links_of_vectors(spark, tile_rows):
    rows = vector_rows()
    table = spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in rows], F32)
    found = [tuple(r) for r in vectors.report(table, tile_rows=tile_rows).collect()]
    assert sorted(found, key=str) == sorted(plain_links(rows), key=str)


def test_links_where_the_first_axis_tells_nothing(spark):
    flat = np.eye(8)[[i % 8 for i in range(80)]] + 0.0
    rows = [(i, v.tolist()) for i, v in enumerate(flat)]
    rows += [(100 + i, (np.eye(8)[i % 7] + np.eye(8)[i % 7 + 1] * (i / 400)).tolist()) for i in range(90)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, vectors.report(table, tile_rows=16).collect())) == sorted(plain_links(rows))


def test_dense_blocks_and_blocks_of_several_tiles(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(8) + 0.01 * rng.normal(size=8)).astype(np.float32).astype(float).tolist()) for i in range(2500)]
    found = vectors.report(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tile_rows=1100).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(2499, 0)} and sum(r["kept"] for r in found) == 1


def test_no_usable_vector(spark):
    assert vectors.report(spark.createDataFrame([], F32)).collect() == []
    found = vectors.report(spark.createDataFrame([(4, None, 0, 0, "", 0), (4, [0.0], 0, 0, "", 0)], F32)).collect()
    assert [tuple(r) for r in found] == [(4, 0, 4, True)] * 2


def test_links_of_the_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").toPandas()
    x = np.stack(table["embedding"].to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    expected = dict(zip(table["vec_id"], ((x @ x.T >= 0.95).sum(axis=1) - 1).tolist()))
    found = queries()["op12_embedding_near_dedup"](spark, small).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == expected and len(found) == len(table)


# --- whitening -----------------------------------------------------------------------

def spectrum(values):
    """A symmetric matrix in extended precision with these eigenvalues, and its vectors."""
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q @ (1.5 * np.eye(n, dtype=np.longdouble) - 0.5 * q.T @ q)
    a = (q * np.asarray(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize("values, within", [
    (20000 - 300 * np.arange(48), 1e-16),
    (2.0 ** -np.arange(30), 1e-16),
    (np.r_[1000 + 1e-3 * np.arange(5)[::-1], 500 + 1e-5 * np.arange(4)[::-1], 40 - np.arange(30)], 1e-9),  # clusters of float32
    (1000 + 1e-6 * np.arange(24)[::-1], 1e-8),  # nothing but one cluster
])
def test_eigenvectors_beyond_float32(values, within):
    a, q = spectrum(values)
    found, x = whitening.refined(a)
    assert np.abs(found - values).max() <= 1e-16 * values[0]
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    assert np.abs(np.abs(np.einsum("ij,ij->j", x, q)) - 1).max() < within


def test_equal_eigenvalues_have_some_basis():
    a, q = spectrum(np.r_[np.full(5, 7.0), np.full(3, 2.0), np.zeros(2)])
    values, x = whitening.refined(a)
    assert np.abs(a @ x - x * values).max() < 1e-16 and np.abs(x.T @ x - np.eye(10)).max() < 1e-17


def plain_white(rows):
    good = [(i, np.floor(1024 * np.array(v)) + 100_000) for i, v in rows]
    x = np.array([v for _, v in good])
    n, y = len(x), x - x.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / n)
    z = y @ axes[:, ::-1] / np.sqrt(values[::-1])
    whole = [[int(c) for c in v] for v in x]
    sums = [sum(c) for c in zip(*whole)]
    far = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in whole]
    return n, z, values[::-1] / values.sum(), far


def test_whitening(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=10) * np.arange(1, 11) * 3 + 40).astype(np.float32).astype(float).tolist()) for i in range(300)]
    bad = [(900, None), (901, []), (902, [1.0] * 9), (903, [math.nan] * 10), (904, [1.0] * 9 + [None]), (905, [1e30] * 10)]
    table = spark.createDataFrame([(i, v, 0, 0, "", 0) for i, v in rows + bad], F32).repartition(5)
    found = whitening.report(table).collect()
    n, z, share, far = plain_white(rows)
    assert len(found) == 8 * len(rows) and {r["n"] for r in found} == {n}
    sign = {}
    for r in found:
        k, i = r["component"] - 1, r["vec_id"]
        sign.setdefault(k, np.sign(r["whitened"] * z[i, k]))
        assert r["whitened"] == pytest.approx(sign[k] * z[i, k], abs=1e-10)
        assert r["deviation"] == far[i]
        assert r["explained"] == pytest.approx(share[k], rel=1e-12) and r["identity_error"] < 1e-12


def test_whitening_of_the_table(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    found = queries()["op13_embedding_whitening"](spark, small).collect()
    n, z, share, far = plain_white(rows)
    place = {i: k for k, (i, _) in enumerate(rows)}
    assert len(found) == 8 * n
    for r in found:
        assert abs(r["whitened"]) == pytest.approx(abs(z[place[r["vec_id"]], r["component"] - 1]), abs=1e-9)
        assert r["deviation"] == far[place[r["vec_id"]]]


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None), (None, [])]])
def test_nothing_that_varies(spark, rows):
    assert whitening.report(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []


def test_fewer_dimensions_than_components_and_null_names(spark):
    rows = [(None, [1.0, 0.0, 5.0]), (None, [0.0, 1.0, 5.0]), (3, [0.0, 0.0, 5.0]), (3, [0.0, 0.0, 5.0])]
    found = whitening.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(found) == 8 and {r["component"] for r in found} == {1, 2} and {r["n"] for r in found} == {4}


def test_sums_beyond_doubles_are_exact(spark):
    big = [(i, [float(2**29 - i), float(i * i) / 1024, 0.5]) for i in range(50)]
    table = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    found = by_id(whitening.report(table).where("component = 1"), "vec_id")
    _, _, _, far = plain_white(big)
    assert {i: r["deviation"] for i, r in found.items()} == {i: f if f < 1 << 63 else None for i, f in enumerate(far)}
