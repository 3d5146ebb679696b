"""Benchmark decontamination with a distributed positional inverted index.

Documents are dealt to segments of about SEGMENT_WORDS words; a document is never divided. A segment's row holds its terms and, for each
term, the positions where it stands (as gaps). The index is written once to the cluster's shared folder and can serve
any number of test sets. A search runs in the segment's own task: for each window of a test item it takes the lists of the
window's terms, rarest in the segment first, shifts each by the term's offset and intersects them; most windows end at the first
term that the segment lacks. Nothing of the index is shuffled.

Test items are the stated query set: they reach the tasks in blocks of bounded size, each block in one pass over the index.

Defined cases: NULL or empty text has no words and no hits; an item without words matches nothing, one shorter than the
window is one window; windows never cross documents; repeated documents give one row each; items that share an identifier
count once, a NULL identifier as the empty string. An item is near a document whose text has the item's three rarest terms (counted in
the test set) within 20 words of the rarest of them; an item of fewer terms is near none. A segment is as long as its longest document at least.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.text import LETTERED, LETTERED_BYTES, ascii_lower, total_bytes, words
from holdfast.sources.storage import fresh_path

SEGMENT_WORDS, BLOCK_BYTES = 2_000_000, 8 << 20
SLOP, RAREST = 20, 3


def _tokens(raw: bytes | None) -> list[bytes]:
    return LETTERED_BYTES.findall(raw.lower()) if raw else []


class _Segment:
    """Documents gathered for one row of the index."""

    def __init__(self) -> None:
        self.vocabulary: defaultdict = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.ids, self.sizes, self.parts, self.words = [], [], [], 0

    def add(self, doc_id, raw: bytes | None) -> None:
        w = _tokens(raw)
        self.ids.append(doc_id)
        self.sizes.append(len(w))
        self.parts.append(np.fromiter(map(self.vocabulary.__getitem__, w), np.int32, len(w)))
        self.words += len(w)

    def row(self, kind: pa.DataType) -> pa.RecordBatch:
        term = np.concatenate(self.parts)
        sizes = np.array(self.sizes, np.int64)
        # one free place after each document keeps phrases from crossing
        shift = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(term, kind="stable")
        at = (np.arange(len(term)) + shift)[order].astype(np.int64)
        n = np.bincount(term, minlength=len(self.vocabulary)).astype(np.int64)
        gaps = np.diff(at, prepend=0)
        first = np.cumsum(n) - n
        if len(n):
            gaps[first] = at[first]
        terms = b" ".join(self.vocabulary)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([[x for x in self.ids]], pa.list_(kind)), pa.array([sizes.tolist()], pa.list_(pa.int64())), pa.array([terms], pa.binary()),
                pa.array([n.astype(np.int32).tobytes()], pa.binary()), pa.array([gaps.astype(np.int32).tobytes()], pa.binary()),
            ],
            names=["ids", "sizes", "terms", "n", "gaps"],
        )


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> str:
    """Writes the index of a table: ids, sizes (words per document), terms, n (places per term), gaps."""
    lean = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("raw"))
    kind = lean.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Segment()
        id_kind = None
        for b in batches:
            id_kind = b.column(0).type
            for d, raw in zip(b.column(0), b.column(1), strict=True):
                held.add(d.as_py(), raw.as_py())
                if held.words >= segment_words:
                    yield held.row(id_kind)
                    held = _Segment()
        if held.ids:
            yield held.row(id_kind)

    made = lean.mapInArrow(run, f"ids array<{kind}>, sizes array<bigint>, terms binary, n binary, gaps binary")
    made.write.option("compression", "zstd").parquet(path)
    return path


class _Searched:
    """One segment's lists, decoded when asked for."""

    def __init__(self, sizes: np.ndarray, terms: bytes, n: bytes, gaps: bytes):
        self.count = np.frombuffer(n, np.int32)
        self.place = {t: i for i, t in enumerate(terms.split(b" "))} if len(self.count) else {}
        self.gaps = np.frombuffer(gaps, np.int32)
        self.first = np.concatenate([[0], np.cumsum(self.count, dtype=np.int64)])
        self.starts = np.cumsum(sizes + 1) - (sizes + 1)
        self.held: dict[int, np.ndarray] = {}

    def places(self, term: int) -> np.ndarray:
        if term not in self.held:
            self.held[term] = np.cumsum(self.gaps[self.first[term] : self.first[term + 1]], dtype=np.int64)
        return self.held[term]

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Places where the terms stand one after another."""
        order = np.argsort(self.count[terms], kind="stable")
        found = self.places(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not len(found):
                break
            more = self.places(terms[k]) - k
            at = np.minimum(np.searchsorted(more, found), len(more) - 1)
            found = found[more[at] == found]
        return found

    def near(self, terms: np.ndarray, slop: int) -> np.ndarray:
        """Places of the first term that have every other term within `slop` words in the same document."""
        found = self.places(terms[0])
        for t in terms[1:]:
            place = self.document(found)
            start, end = self.starts[place], np.append(self.starts[1:], 1 << 60)[place]
            more = np.concatenate([[-(1 << 60)], self.places(t), [1 << 60]])
            at = np.searchsorted(more, found)
            before, after = more[at - 1], more[at]
            found = found[((after < end) & (after - found <= slop)) | ((before >= start) & (found - before <= slop))]
        return found

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1


def _search(seg: _Searched, items: list[tuple[str, list[bytes], list[bytes]]], window: int, slop: int):
    """Covered stretches and items by document number, and items near it."""
    spans, found, near = [], defaultdict(set), defaultdict(set)
    for item, w, few in items:
        terms = np.array([seg.place.get(x, -1) for x in w], np.int64)
        n = min(window, len(w))
        absent = np.concatenate([[0], np.cumsum(terms < 0)])
        for i in np.flatnonzero(absent[n:] == absent[:-n] if n else []):
            at = seg.phrase(terms[i : i + n])
            if len(at):
                spans.append(np.stack([at, at + n], 1))
                for d in np.unique(seg.document(at)):
                    found[d].add(item)
        if few and all(x in seg.place for x in few):
            for d in np.unique(seg.document(seg.near(np.array([seg.place[x] for x in few]), slop))):
                near[d].add(item)
    return np.concatenate(spans) if spans else np.zeros((0, 2), np.int64), found, near


def search(spark: SparkSession, path: str, items: list[tuple[str, list[bytes], list[bytes]]], window: int = 10, slop: int = SLOP) -> DataFrame:
    """One pass over an index: id, segment row, n_words, spans, items, near for every document.

    items: (name, words, terms for proximity). In the result, spans: covered stretches of words, apart from each other; items: items of
    which a window occurs; near: items whose terms for proximity all stand within `slop` words of the first of them in the document.
    """
    sent = spark.sparkContext.broadcast(items)
    index = spark.read.parquet(path)
    kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"id {kind}, row string, n_words bigint, spans array<struct<s:bigint,e:bigint>>, items array<string>, near array<string>"
    span = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                ids, sizes, terms, n, gaps, name = (b.column(j)[k] for j in range(6))
                size = np.array(sizes.as_py(), np.int64)
                seg = _Searched(size, terms.as_py(), n.as_py(), gaps.as_py())
                hits, found, near = _search(seg, sent.value, window, slop)
                edge = np.zeros(int((size + 1).sum()) + 1, np.int32)
                np.add.at(edge, hits[:, 0], 1)
                np.add.at(edge, hits[:, 1], -1)
                turns = np.diff(np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8)]))
                s, e = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
                at = seg.document(s)
                by: dict[int, list] = defaultdict(list)
                for d, x, y in zip(at.tolist(), s.tolist(), e.tolist(), strict=True):
                    by[d].append({"s": x - int(seg.starts[d]), "e": y - int(seg.starts[d])})
                m = len(size)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values, pa.array([f"{name.as_py()}/{d}" for d in range(m)]), pa.array(size), pa.array([by.get(d, []) for d in range(m)], span),
                        pa.array([sorted(found[d]) if d in found else [] for d in range(m)], pa.list_(pa.string())),
                        pa.array([sorted(near[d]) if d in near else [] for d in range(m)], pa.list_(pa.string())),
                    ],
                    names=["id", "row", "n_words", "spans", "items", "near"],
                )

    # a segment's name: its terms and sizes tell it from others, and any order of reading gives the same
    name = F.concat_ws("-", F.xxhash64("ids", "sizes", "terms"), F.xxhash64("gaps"), F.col("_metadata.file_name"))
    return index.select("ids", "sizes", "terms", "n", "gaps", name.alias("name")).mapInArrow(run, schema)


def rarest_terms(items: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(item, raw, few): the terms of an item that are rarest in the whole test set, the rarest first, ties in byte order.

    None for an item of fewer distinct terms.
    """
    term = words(ascii_lower(F.col("raw").cast("string")), LETTERED)
    counts = items.select(F.explode(term).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    own = items.select("item", "raw", F.explode(F.array_distinct(term)).alias("term")).distinct()
    few = F.slice(F.array_sort(F.collect_list(F.struct("n", "term"))), 1, rarest)["term"]
    return own.join(counts, "term").groupBy("item", "raw").agg(few.alias("few")).filter(F.size("few") == rarest)


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = 10,
    proximity: bool = True,
) -> DataFrame:
    """(id, n_words, n_hit, items, near) of every document against all items of a benchmark table.

    near is left empty without `proximity`.
    """
    spark = docs.sparkSession
    path = build_index(docs, fresh_path(spark, "postings"), id_col, text_col)
    asked = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("raw"))
    blocks = max(1, ceil(total_bytes(asked, "raw") / BLOCK_BYTES))
    if proximity:
        asked = asked.join(rarest_terms(asked), ["item", "raw"], "left")
    else:
        asked = asked.withColumn("few", F.array().cast("array<string>"))
    told = None
    for k in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("item", "raw"), F.lit(blocks)) == k)
        one = search(spark, path, [
            (r["item"], _tokens(bytes(r["raw"] or b"")), [x.encode() for x in r["few"] or []]) for r in block.toLocalIterator()
        ], window)
        told = one if told is None else told.unionByName(one)
    if blocks > 1:  # a document's stretches and items of all blocks together
        told = told.groupBy("row", "id", "n_words").agg(
            F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"),
        )
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    grow = lambda a, x: F.struct(
        F.greatest(a["end"], x["e"]).alias("end"), (a["n"] + F.greatest(x["e"] - F.greatest(a["end"], x["s"]), F.lit(0))).alias("n")
    )
    return told.select("id", "n_words", F.aggregate("spans", zero, grow, lambda a: a["n"]).alias("n_hit"), "items", "near")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the items near it: n_near, near_sha256."""
    found = matches(docs, benchmark)
    listed, near = (F.array_join(F.array_sort(c), ",") for c in ("items", "near"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near"), F.sha2(near, 256).alias("near_sha256"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without any window of a test item, all columns as they are. Rows are judged by identifier and text."""
    digest = F.coalesce(F.sha2(F.col(f"`{text_col}`").cast("binary"), 256), F.lit(""))
    told = docs.withColumn("_digest", digest)
    keyed = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), digest.alias("digest")).alias("row"), F.col(f"`{text_col}`").alias("text"))
    bad = matches(keyed, benchmark, "row", "text", proximity=False).filter("n_hit > 0").select(F.col("id.id").alias("bad_id"), F.col("id.digest").alias("bad_digest")).distinct()
    clean = told.join(bad, told[id_col].eqNullSafe(bad["bad_id"]) & (told["_digest"] == bad["bad_digest"]), "left_anti")
    return clean.select(*(F.col(f"`{c}`") for c in docs.columns))
