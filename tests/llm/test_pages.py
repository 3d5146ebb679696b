"""Page extraction, WARC audit and preference formatting."""

import gzip
import html
import pathlib
import re
import shutil
import time

import pytest
from pyspark.sql import functions as F

from holdfast.llm import pages, preferences, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, text string, record string"


@pytest.fixture(scope="module")
def tree(spark):
    return pages.train(spark)


def test_articles_of_the_table(spark, tree):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in pages.extracted(rows, tree=tree).collect()}
    for r in rows.collect():
        body = r.html.split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[r.page_id] == "\n\n".join(x for x in parts if x)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("<p></p>", ""),
        ("<article><h1>T</h1><p>a <a>b</a> c</p><form><p>x y z</p></form><p>&lt;b&gt; &amp;\n z<br>w</p><div class='share'>s</div></article>", "T\n\na b c\n\n<b> & z w"),
        ("<article><p>one</p><!-- <p>no</p> --><script>var t='</p><p>no';</script><style>p{}</style><p>two</article><footer>f", "one\n\ntwo"),
        ("<article><p>a</p></article><section id=comments><article><p>" + "said " * 60 + "</p></article></section>", "a"),
        ("<article><p>3 < 4 &unknown; &#233;</p><p>end", "3 < 4 &unknown; é\n\nend"),
        ("<main><p>" + "long " * 50_000 + "</p></main>", ("long " * 50_000).strip()),
    ],
)
def test_small_pages(tree, page, want):
    assert pages.main_text(page, tree) == want


LONG = "long words of the page " * 9


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>only text</p>", "only text"), ("only text", "only text"), ("<body><div>x</div></body>", "x"),
        (f"<p>{LONG}</p><p>{LONG}</p><p>the last one</p>", f"{LONG.strip()}\n\n{LONG.strip()}\n\nthe last one"),
        ("<article><p><a>one</a></p><p>plain words</p><p><a>two</a> b</p></article>", "one\n\nplain words\n\ntwo b"),
        ("<article><div class='article-header'><h1>T</h1></div><div class='share-price'>12</div><p>t</article>", "T\n\n12\n\nt"),
        ("<article><ul><li class='share'>no<li>yes<li>and that</ul></article>", "yes\n\nand that"),
        ("<article><p>so <math><mi>x</mi></math> it</p><p hidden>no</p><p style='display:none'>no<p>a<i style='display: none'>no</i></article>", "so x it\n\na"),
        ("<div class='ad'>buy<article><p>text</p></article><footer>f", "text"),
        ("<div class='related'><article><p>teaser</p></article></div><article><p>text</p></article>", "text"),
        ("<form><article><p>text</p></article></form>", "text"),
        ("<nav><ul><li><a>" + LONG + "</a></li></ul></nav><article><p>t</p><nav><a>" + LONG + "</a></nav></article>", "t"),
        (f"<h1>T</h1><p>{LONG}</p><div>log in</div><ul><li><a>x</a><li><a>y</a></ul>", f"T\n\n{LONG.strip()}"),
        (f"<p>{LONG}</p><ul><li>first of all<li>then this</ul><p>{LONG}</p>", f"{LONG.strip()}\n\nfirst of all\n\nthen this\n\n{LONG.strip()}"),
    ],
)
def test_pages_of_other_kinds(tree, page, want):
    assert pages.main_text(page, tree) == want


def test_names_are_read_whole():
    assert [pages.hints(x)[0] for x in ("ad", "siteFooter", "cookie-notice box", "top_nav", "load", "share-price", "article-header", "badge header-image")] == [
        True, True, True, True, False, False, False, False]
    assert pages.hints("post-comments") == (True, True) and pages.hints("") == (False, False)


def test_held_out_pages(tree):
    """Pages drawn anew, half of them without an article element; own words, links and places all count in the tree."""
    wrong = total = 0
    for page, marks in pages.labelled_pages(400, seed=2):
        found = pages.blocks(page)
        said = [pages._says(tree, x) for x in pages.features(found)]
        assert len(said) == len(marks)
        wrong, total = wrong + sum(str(a) != b for a, b in zip(said, marks, strict=True)), total + len(marks)
    assert wrong <= 0.005 * total

    def used(x):
        return set() if isinstance(x, int) else {pages.FEATURES[x[0]]} | used(x[2]) | used(x[3])

    assert {"words", "density", "words_before", "words_after"} <= used(tree)


def test_articles_without_their_element(spark, tree):
    """The pages of the table with the article as a bare element: the same text is found by its blocks alone."""
    rows = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert rows
    for page in rows:
        bare = page.replace("<article>", "<div>").replace("</article>", "</div>")
        assert pages.main_text(bare, tree) == pages.main_text(page, tree)


@pytest.mark.parametrize("bit", ["<ul><li>x", "<div>", "<a ", '<a "', "<svg>", '<p class="a>', "x<", "<div class=ad>a", "<!--", "<p a='", "<p><h2>x"])
def test_cutting_is_linear(bit):
    took = []
    for n in (4_000, 32_000):
        start = time.perf_counter()
        pages.blocks(bit * n + ">y")
        took.append(time.perf_counter() - start)
    assert took[1] < 30 * took[0] + 0.2  # quadratic: 64 times


def test_extraction_keeps_rows(spark, tree):
    rows = spark.createDataFrame([(1, "u", None, "x", "y"), (1, "u", None, "x", "y"), (None, None, "<p>q</p>", "", "")], SCHEMA)
    assert pages.extracted(rows, tree=tree).count() == 3 and pages.extracted(rows.limit(0), tree=tree).count() == 0


def test_audit_finds_what_was_damaged(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    more = spark.createDataFrame([(None, None, None), (7, "a\r\nb", ""), (7, "a\r\nb", "")], "page_id long, url string, html string")
    rows = rows.unionByName(more)
    got = warc.report(rows, every=7)
    assert got.count() == rows.count()
    hit = F.pmod(F.xxhash64("page_id"), F.lit(7)) == 0
    assert got.filter((F.col("status") != "ok") != hit).count() == 0 and got.filter(hit).count() > 0
    assert warc.report(rows.limit(0)).count() == 0


def test_audit_goes_down_several_levels(spark):
    leaves = spark.range(500).select((F.col("id") % 5).cast("int").alias("file_no"), F.floor(F.col("id") / 5).cast("int").alias("place"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    bad = leaves.withColumn("digest", F.when((F.col("file_no") == 3) & (F.col("place") == 77), "x").otherwise(F.col("digest")))
    bad = bad.filter("not (file_no = 1 and place = 99)")
    got = warc.audit(leaves, bad, fanout=3).filter("status <> 'ok'").select("file_no", "place", "status").collect()
    assert sorted(map(tuple, got)) == [(1, 99, "missing"), (3, 77, "changed")]
    roots = [warc.tree(x, warc._heights(leaves, leaves, 3), 3)[-1].collect() for x in (leaves, leaves.repartition(7), bad)]
    assert len(roots[0]) == 1 and roots[0] == roots[1] != roots[2]


def _stored(path):
    return {f.parent.name: f for f in pathlib.Path(path).rglob("part-*")}


def _hurt(raw, ranges, how):
    """A file with its fourth record changed in some way, and the status that this should have."""
    at, length = ranges[3]
    end = at + length
    other = gzip.compress(b"another record", mtime=0)
    return {
        "flip": (raw[: at + 30] + bytes([raw[at + 30] ^ 255]) + raw[at + 31 :], {3: "damaged"}),
        "flip header": (raw[:at] + b"\0" + raw[at + 1 :], {3: "damaged"}),
        "insert": (raw[: at + 30] + b"new" + raw[at + 30 :], {3: "damaged"}),
        "remove": (raw[:at] + raw[end + len(warc.BETWEEN) :], {3: "missing"}),
        "cut": (raw[: at + 40], {3: "damaged"} | {k: "missing" for k in range(4, len(ranges))}),
        "replace": (raw[:at] + warc.member(b"another record") + raw[end:], {3: "changed"}),
        "add": (raw[:at] + warc.member(b"another record") + raw[at:], {None: "added"}),
        "append": (raw + b"tail", {None: "added"}),
        "foreign": (raw + other, {None: "added"}),
        "empty": (b"", {k: "missing" for k in range(len(ranges))}),
    }[how]


HOWS = ["flip", "flip header", "insert", "remove", "cut", "replace", "add", "append", "foreign", "empty"]


def test_damage_on_disk(spark, tmp_path, monkeypatch):
    """Bytes of the stored files are flipped, cut, inserted and appended, a file is lost and one is new; all else is intact."""
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    warc.ensure_checkpoint_dir(spark)
    rows = spark.range(400).selectExpr("id AS page_id", "concat('u', id) AS url", "repeat(sha2(string(id), 512), 4 + int(id % 9)) AS html")
    packed = warc.members(warc.records(rows))
    listed = warc.manifest(packed).checkpoint()
    stored = warc.write(packed, str(tmp_path / "stored"))["one"]
    path = shutil.copytree(stored, tmp_path / "replica", ignore=shutil.ignore_patterns(".*.crc")).as_posix()
    files, places = _stored(path), {}
    for r in listed.orderBy("file_no", "place").collect():
        places.setdefault(r.file_no, []).append((r.start, r.length))
    assert len(files) == len(places) > len(HOWS) + 2
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in files.values())  # any reader of gzip can unpack them
    assert whole.count(b"WARC/1.1") == 400
    ok = warc.audit(listed, warc.leaves(spark, path), fanout=4)
    assert ok.count() == 400 and ok.filter("status <> 'ok' OR place <> found_place").count() == 0

    want = set()
    for no, how in enumerate(HOWS):
        new, says = _hurt(files[f"file_no={no}"].read_bytes(), places[no], how)
        files[f"file_no={no}"].write_bytes(new)
        want |= {(no, place, status) for place, status in says.items()}
    gone = len(HOWS)
    files[f"file_no={gone}"].write_bytes(b"")
    want |= {(gone, k, "missing") for k in range(len(places[gone]))}
    (tmp_path / "replica" / "extra.gz").write_bytes(warc.member(b"stray"))
    got = warc.audit(listed, warc.leaves(spark, path), fanout=4).filter("status NOT IN ('ok', 'moved')").collect()
    found = {(r.file_no if r.file_no >= 0 else "extra", r.place, r.status) for r in got}
    assert found == want | {("extra", None, "added")} and len(got) == len(found)

    one = _stored(stored)["file_no=0"]  # the store has checksums of its own and refuses this file
    one.write_bytes(bytes(len(one.read_bytes())))
    got = warc.audit(listed, warc.leaves(spark, stored), fanout=4).filter("status <> 'ok'").collect()
    assert sorted((r.file_no, r.place, r.status) for r in got) == [(0, k, "missing") for k in range(len(places[0]))]


def test_audit_leaves_clashing_columns_out(spark):
    rows = spark.range(30).selectExpr("id AS page_id", "'u' AS url", "string(id) AS html", "1 AS file_no", "2 AS place", "3 AS digest", "4 AS record")
    got = warc.report(rows, every=5).collect()
    assert sorted(r.page_id for r in got) == list(range(30)) and all(r.whole_elsewhere for r in got)
    assert {r.status for r in got} == {"ok", "damaged"}


def _brute(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    return n


def test_preferences(spark):
    talks = {
        0: [("system", "s"), ("user", "q"), ("assistant", "yes")], 1: [("system", "s"), ("user", "q"), ("assistant", "no"), ("user", "why")],
        2: [("user", "same")], 3: [("user", "same")], 4: [("user", None), ("assistant", "a <|im_end|> b")], 6: [("user", "x")], 7: [("user", "y"), (None, "")],
        8: [("user", "a"), ("assistant", "b")], 9: [("user", "a")],
    }
    rows = [(c, i, r, t, "?") for c, talk in talks.items() for i, (r, t) in enumerate(talk)] + [(None, 0, "user", "lost", "?")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pair_id string").repartition(4)
    got = {r.pair_id: r for r in preferences.formatted(turns, preferences.neighbours(turns)).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    show = lambda turn: f"<|im_start|>{turn[0] or ''}\n{(turn[1] or '').replace('<|', '< |')}<|im_end|>\n"
    for k, r in got.items():
        a, b = talks.get(2 * k), talks.get(2 * k + 1)
        n = _brute(a, b) if a and b else len(a or b)
        assert r.n_common == n and r.prompt == "".join(map(show, (a or b)[:n]))
        for talk, text, spans in ((a, r.chosen, r.chosen_spans), (b, r.rejected, r.rejected_spans)):
            rest = talk[n:] if a and b else []
            assert text == "".join(map(show, rest))
            assert [text[s.start : s.end] for s in spans] == [show(t)[len("<|im_start|>assistant\n") : -1] for t in rest if t[0] == "assistant"]
    assert preferences.formatted(turns.limit(0), preferences.neighbours(turns.limit(0))).count() == 0
