"""Fixity audit of WARC replicas with Merkle trees.

A record's leaf is the SHA-256 of its bytes, at its place in the file. Nodes above hash the digests of up to FANOUT
children in the order of their offsets, up to one root per file, and on over the files to one root per replica. An audit compares
roots and goes down only where they differ, so two replicas that agree exchange one digest, and a damaged record costs
a path. Within a file that differs, records are then matched by digest, so that what stands between two intact records is told
apart: changed, damaged, missing, added, or only moved.

Each record is a gzip member of its own, packed before it is shuffled to its file; an empty member, which unpacks to nothing, stands
between two. A reader finds members by their fixed header, so bytes that cannot be unpacked cost one record and not the file. Writing
and reading use Spark's own sources (text with the empty member as separator, binary files), so any store that Spark reads will do.
A file is one task's rows and has about FILE_BYTES before packing; a larger record has a file of its own size.

Defined cases: NULL page, url or html count as empty in the record; line breaks in an url are dropped; rows repeated in full
are records of their own, in one file; further columns are left out; an empty table has no files and no root; files and records that
a replica lacks, or that its store refuses to read, are missing; records and files that only the replica has are added, as is what stands between records
and is none; an order other than the manifest's is moved.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.sources.storage import ensure_checkpoint_dir, fresh_path, path_exists, removed

FANOUT, FILE_BYTES, SEPARATOR = 16, 8 << 20, "\r\n\r\n"
HEADER = b"\x1f\x8b\x08\0\0\0\0\0\0\xff"  # of a gzip member without time and name
BETWEEN = HEADER + b"\x03\0" + bytes(8)  # an empty member
DAMAGED = "-"  # in the place of a digest


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, record, file_no): each page as a WARC record without its trailing separator, dealt to files."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    lean = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.regexp_replace(text("url"), r"[\r\n]", ""),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), text("page_id"), F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(text("html")).cast("string"), F.lit("\r\n\r\n"),
    )
    n = lean.agg(F.sum(F.octet_length(text("html")) + 200)).first()[0] or 0
    file_no = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(max(1, ceil(n / FILE_BYTES)))).cast("int")
    return lean.select("page_id", "url", F.concat(head, text("html")).alias("record"), file_no.alias("file_no"))



def member(record: bytes) -> bytes:
    """A record as a gzip member with HEADER, the same bytes wherever it is packed."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    return HEADER + body + zlib.crc32(record).to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little")


def members(recs: DataFrame) -> DataFrame:
    """(file_no, page_id, url, digest, member) of records, where they are: only `write` shuffles members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 64):
                some = b.slice(at, 64)
                raw = [(x.as_py() + SEPARATOR).encode() for x in some.column(3)]
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(i) for i in range(3)), pa.array([hashlib.sha256(x).hexdigest() for x in raw]), pa.array(map(member, raw), pa.binary())],
                    names=["file_no", "page_id", "url", "digest", "member"],
                )

    lean = recs.select("file_no", "page_id", "url", "record")
    kind = lambda c: lean.schema[c].dataType.simpleString()
    return lean.mapInArrow(run, f"file_no int, page_id {kind('page_id')}, url {kind('url')}, digest string, member binary")


def manifest(packed: DataFrame) -> DataFrame:
    """(file_no, place, start, length, page_id, url, digest): the range of bytes of each member, and what it should hash to."""
    lean = packed.select("file_no", "page_id", "url", F.octet_length("member").cast("long").alias("length"), "digest")
    by = W.partitionBy("file_no").orderBy("page_id", "digest", "url")
    start = F.coalesce(F.sum(F.col("length") + len(BETWEEN)).over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return lean.withColumns({"place": F.row_number().over(by) - 1, "start": start})


def write(packed: DataFrame, path: str, replicas: dict[str, Column | None] | None = None, files: int | None = None) -> dict[str, str]:
    """Replicas of WARC files in one pass, one folder per replica and file number, members in the manifest's order; their paths.

    replicas: name -> where a byte in the middle of the member is another one, as if that store had lost it. files: their
    number, where it is known.
    """
    n = files or (packed.agg(F.max("file_no")).first()[0] or 0) + 1
    replicas = replicas or {"one": None}
    half = F.floor(F.octet_length("member") / 2).cast("int")
    byte = F.substring("member", half, F.lit(1))
    other = F.when(byte == F.lit(b"\x00"), F.lit(b"\x01")).otherwise(F.lit(b"\x00"))
    flipped = F.concat(F.substring("member", F.lit(1), half - 1), other, F.substring("member", half + 1, F.octet_length("member")))
    lost = F.lit(False)
    for name, where in replicas.items():
        lost = lost | ((F.col("replica") == name) & F.coalesce(where, F.lit(False))) if where is not None else lost
    rows = packed.repartition(n, "file_no").withColumn("replica", F.explode(F.array(*map(F.lit, replicas))))
    rows = rows.withColumn("value", F.when(lost, flipped).otherwise(F.col("member")).cast("string"))
    rows = rows.sortWithinPartitions("replica", "file_no", "page_id", "digest", "url")
    sink = rows.select("replica", "file_no", "value").write.partitionBy("replica", "file_no").option("encoding", "ISO-8859-1")
    sink.option("lineSep", BETWEEN.decode("latin-1")).text(path)
    return {name: f"{path}/replica={name}" for name in replicas}


def scanned(raw: bytes) -> Iterator[tuple[int, int, str]]:
    """(start, length, digest) of what stands in a file, empty members left out, DAMAGED for bytes that are no whole member."""
    at = raw.find(HEADER)
    if raw and at:
        yield 0, len(raw) if at < 0 else at, DAMAGED
    while at >= 0:
        after = raw.find(HEADER, at + len(HEADER))
        end = after if after >= 0 else len(raw)
        unpacker = zlib.decompressobj(31)
        try:
            body = unpacker.decompress(memoryview(raw)[at:end])
            used = end - len(unpacker.unused_data) if unpacker.eof else at
        except zlib.error:
            used = at
        if used > at and body:
            yield at, used - at, hashlib.sha256(body).hexdigest()
        if used < end:
            yield used, end - used, DAMAGED
        at = after


def leaves(spark, path: str) -> DataFrame:
    """(file_no, place, start, length, digest) of a replica. Files that the manifest's layout has no name for get negative numbers."""
    if not path_exists(spark, path):  # a replica without files
        return spark.createDataFrame([], "file_no int, place int, start bigint, length bigint, digest string")
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", ignoreCorruptFiles="true").load(path)
    told = F.regexp_extract("path", r"/file_no=(\d{1,9})/", 1)
    number = F.when(told != "", told.cast("int")).otherwise((-1 - F.pmod(F.xxhash64("path"), F.lit(1 << 30))).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for no, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found = list(scanned(content.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([no] * len(found), pa.int32()), pa.array(range(len(found)), pa.int32()),
                     *(pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))],
                    names=["file_no", "place", "start", "length", "digest"],
                )

    return files.select(number.alias("file_no"), "content").mapInArrow(run, "file_no int, place int, start bigint, length bigint, digest string")


def _up(nodes: DataFrame, keep: list[str], at: str, fanout: int) -> DataFrame:
    children = F.sort_array(F.collect_list(F.struct(at, "digest")))
    above = nodes.groupBy(*keep, F.floor(F.col(at) / fanout).cast("int").alias("up")).agg(children.alias("c"))
    digest = F.sha2(F.array_join(F.transform("c", lambda x: x["digest"]), ""), 256)
    return above.select(*keep, F.col("up").alias(at), digest.alias("digest"))


def _heights(one: DataFrame, two: DataFrame, fanout: int) -> tuple[int, int]:
    """Levels above the leaves within files and above the files, enough for both replicas."""
    both = one.select("place", "file_no").unionByName(two.select("place", "file_no"))
    top = both.agg(F.max("place"), F.max(F.abs("file_no"))).first()
    level = lambda n: next(k for k in range(64) if (n or 0) < fanout**k)
    return level(top[0]), level(top[1])


def tree(leaves: DataFrame, heights: tuple[int, int], fanout: int = FANOUT) -> list[DataFrame]:
    """Levels from the leaves to the root: (file_no, place, digest), places of the upper levels being 0.

    Levels above the leaves are checkpointed, so that each is hashed once and plans stay short.
    """
    levels = [leaves.select("file_no", "place", "digest")]
    for _ in range(heights[0]):
        levels.append(_up(levels[-1], ["file_no"], "place", fanout).checkpoint())
    for _ in range(heights[1]):
        levels.append(_up(levels[-1], ["place"], "file_no", fanout).select("file_no", "place", "digest").checkpoint())
    return levels


def differing(one: list[DataFrame], two: list[DataFrame], heights: tuple[int, int], fanout: int = FANOUT) -> DataFrame:
    """(file_no, place, digest, found) of the leaves that differ, found by going down from the roots.

    digest and found: of the two replicas, NULL in the one that has no such leaf.
    """
    at = None
    for level in range(len(one) - 1, -1, -1):
        a, b = one[level], two[level].withColumnRenamed("digest", "found")
        if at is not None:  # only children of nodes that differ
            files = level >= heights[0]
            up = [F.floor(F.col("file_no") / fanout).cast("int") if files else F.col("file_no"), F.col("place") if files else F.floor(F.col("place") / fanout).cast("int")]
            below = lambda x, up=up, at=at: x.withColumns({"u": up[0], "v": up[1]}).join(at, ["u", "v"], "left_semi").drop("u", "v")
            a, b = below(a), below(b)
        both = a.join(b, ["file_no", "place"], "full").filter(~F.col("digest").eqNullSafe(F.col("found"))).checkpoint()
        at = both.select(F.col("file_no").alias("u"), F.col("place").alias("v"))
    return both


def _explained(one: DataFrame, two: DataFrame) -> DataFrame:
    """(file_no, place, found_place, status) of all records of files that differ.

    Records of one digest match in their order. What is left stands in a gap, numbered by the matched records before it, and
    is paired in order with what the other replica has in that gap.
    """
    nth = F.row_number().over(W.partitionBy("file_no", "digest").orderBy("place")).alias("nth")
    a, b = (x.select("file_no", "place", "digest", nth) for x in (one, two))
    key = ["file_no", "digest", "nth"]
    both = a.join(b.withColumnRenamed("place", "found_place").filter(F.col("digest") != DAMAGED), key, "full").checkpoint()
    whole = F.col("place").isNotNull() & F.col("found_place").isNotNull()
    same = both.filter(whole).select("file_no", "place", "found_place", F.when(F.col("place") == F.col("found_place"), "ok").otherwise("moved").alias("status"))

    def left(rows: DataFrame, at: str) -> DataFrame:
        """Unmatched records with their gap and their number in it."""
        known = both.filter(whole).select("file_no", F.col(at).alias("place"), F.lit(1).alias("known"))
        rows = rows.join(known, ["file_no", "place"], "left")
        gap = F.count("known").over(W.partitionBy("file_no").orderBy("place"))
        rows = rows.withColumn("gap", gap).filter("known IS NULL")
        return rows.withColumn("j", F.row_number().over(W.partitionBy("file_no", "gap").orderBy("place")))

    lost = left(a, "place").select("file_no", "gap", "j", "place")
    other = left(b, "found_place").select("file_no", "gap", "j", F.col("place").alias("found_place"), F.col("digest").alias("found"))
    status = (
        F.when(F.col("found_place").isNull(), "missing").when(F.col("place").isNull(), "added")
        .when(F.col("found") == DAMAGED, "damaged").otherwise("changed")
    )
    return same.unionByName(lost.join(other, ["file_no", "gap", "j"], "full").select("file_no", "place", "found_place", status.alias("status")))


def audit(listed: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The manifest with found_place and status (ok, moved, changed, damaged, missing), and a row for all that was added."""
    ensure_checkpoint_dir(listed.sparkSession)
    heights = _heights(listed, replica, fanout)
    bad = differing(tree(listed, heights, fanout), tree(replica, heights, fanout), heights, fanout).select("file_no").distinct()
    told = _explained(*(x.join(bad, "file_no", "left_semi") for x in (listed, replica))).checkpoint()
    rows = listed.join(told.filter("place IS NOT NULL"), ["file_no", "place"], "left")
    rows = rows.withColumns({"found_place": F.when(F.col("status").isNull(), F.col("place")).otherwise(F.col("found_place")), "status": F.coalesce("status", F.lit("ok"))})
    ranges = [c for c in ("start", "length") if c in replica.columns]
    more = told.filter("place IS NULL").drop("place").join(
        replica.select("file_no", F.col("place").alias("found_place"), "digest", *ranges), ["file_no", "found_place"]
    )
    return rows.unionByName(more, allowMissingColumns=True)


def report(pages: DataFrame, every: int = 97) -> DataFrame:
    """Writes the pages as two replicas of WARC files, one member in `every` of the second with a byte lost, reads and audits both.

    Returns page_id, url, file_no, place, start, length, digest, status of the second replica and whether the first one has the
    record whole, one row per page.
    """
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    packed = members(records(pages))
    listed = manifest(packed).checkpoint()
    hit = F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0
    path = fresh_path(spark, "warc")
    paths = write(packed, path, {"one": None, "two": hit}, (listed.agg(F.max("file_no")).first()[0] or 0) + 1)
    one, two = (audit(listed, leaves(spark, paths[x]).checkpoint()) for x in ("one", "two"))
    removed(spark, path)  # all that is read of them is checkpointed
    whole = one.select("file_no", "place", F.col("status").isin("ok", "moved").alias("whole_elsewhere"))
    both = two.join(whole, ["file_no", "place"], "left")
    return both.select("page_id", "url", "file_no", "place", "start", "length", "digest", "status", "whole_elsewhere")
