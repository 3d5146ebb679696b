"""Removal of repeated passages with suffix arrays of shards.

A byte goes if it lies in a string of `size` bytes that also starts in a document with a smaller identifier.

1. Exact copies of a smaller document go as a whole; the rest of the work sees one document of each set of copies.
2. Every string of `size` bytes (a window) belongs to the smallest hash of its `GRAM`-byte grams. Equal windows have the same
   smallest hash, so only hashes that occur in two documents can hold a repeat (packs exchange their distinct hashes).
3. Runs of windows with one such hash are cut out as pieces. Pieces go to the shard of their hash, each content once per
   pack; hashes with very many occurrences send single windows to the shard of the window's own hash instead, so that a
   common passage with many surroundings spreads over all shards.
4. A shard builds the suffix array of its pieces by induced sorting and the permuted common prefixes (`suffixes`); windows
   next to each other with `size` common bytes are one class, and the class's smallest document is its owner.
5. Packs learn, window by window, whether the owner precedes them, and cut their documents.

Steps 2 and 3 only leave out what provably repeats nowhere; what is a repeat is decided by the suffix arrays.

Defined cases: NULL text is empty; a NULL identifier comes after all others; rows with one identifier don't remove each
other's text; texts shorter than a window stay; matches never cross documents; the input decides, not what is left of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.packs import by_range, dealt, mix, partitions
from holdfast.llm.suffixes import common_prefixes, suffix_array

GRAM, PIECE, CHUNK, HOT = 16, 64, 1 << 18, 10_000
PACK = 6 << 20
LAST = (1 << 63) - 1
TOLD = "pack int, kind int, bucket int, ids array<struct<id:bigint,print:binary>>, told binary"
EMPTY = hashlib.sha256(b"").hexdigest()


def smallest_hashes(b: np.ndarray, size: int) -> np.ndarray:
    """Smallest gram hash of each window of a byte string of at least `size` bytes."""
    n, span = len(b) - 7, size - GRAM + 1
    word = np.empty(n, np.uint64)
    for o in range(8):
        k = (len(b) - o) // 8
        part = np.frombuffer(b.data, np.uint64, k, o)
        word[o::8] = part[: len(word[o::8])]
    # any function of a gram's bytes will do, as hashes only say where to look
    h = word[:-8] * np.uint64(0x9E3779B97F4A7C15)
    h += word[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    step = 1
    while 2 * step <= span:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[: len(h) - (span - step)], h[span - step :]) if step < span else h


class _Pack:
    """The pack's documents that are no copies, and the runs of windows they consist of."""

    def __init__(self, table: pa.Table, copies: set[tuple[int, bytes]], size: int):
        self.size = size
        ids = [LAST if x is None else x for x in table.column("id").to_pylist()]
        self.rows = [(d, raw.as_py()) for d, raw in zip(ids, table.column("raw"), strict=True)]
        self.copied = [bool(copies) and len(raw) >= size and (d, hashlib.sha256(raw).digest()) in copies for d, raw in self.rows]
        own = {(d, raw) for (d, raw), gone in zip(self.rows, self.copied, strict=True) if len(raw) >= size and not gone}
        self.texts = sorted(own)  # any order of the rows gives the same
        at, held, parts = 0, [], []
        for k, (_, raw) in enumerate(self.texts):
            held.append((k, at, raw))
            at += len(raw)
            if at >= CHUNK or k == len(self.texts) - 1:
                parts.append(self._runs(held))
                at, held = 0, []
        none = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
        self.text, self.start, self.windows, self.key = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else none

    def _runs(self, held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        joined = np.frombuffer(b"".join(raw for _, _, raw in held), np.uint8)
        smallest = smallest_hashes(joined, self.size)
        offset = np.array([at for _, at, _ in held])
        count = np.array([len(raw) - self.size + 1 for _, _, raw in held])
        which = np.repeat(np.arange(len(held)), count)
        within = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        key = smallest[offset[which] + within]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (which[1:] != which[:-1])])
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(key)))
        pieces = -(-length // PIECE)  # long runs of one hash are cut; windows stand for themselves
        again = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(first, pieces) + again * PIECE
        length = np.minimum(np.repeat(length, pieces) - again * PIECE, PIECE)
        number = np.array([k for k, _, _ in held])
        # smallest values crowd at the lower end: spread them, as they are dealt to ranges
        return number[which[first]], within[first], length, mix(key[first])

    @cached_property
    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes, in how many documents of other identifiers each occurs (0: only one), and the place of each run's hash."""
        ids = np.array([d for d, _ in self.texts], np.int64)[self.text] if len(self.texts) else self.text
        order = np.argsort(self.key, kind="stable")  # runs stand in the order of their identifiers
        key, ids = self.key[order], ids[order]
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        if not len(first):
            return key, first, first
        place = np.empty(len(key), np.int32)
        place[order] = np.cumsum(new) - 1
        steps = np.concatenate([[0], (ids[1:] != ids[:-1]).astype(np.int64)])
        steps[first] = 0
        return key[first], np.add.reduceat(steps, first), place

    def pieces(self, told: np.ndarray, shards: int) -> _Pieces:
        """Occurrences of repeated pieces and what is sent of them."""
        state = told[self.keys[2]] if len(self.key) else np.zeros(0, np.uint8)
        return _Pieces(self, state, shards)


class _Pieces:
    """Repeated pieces of a pack.

    at: text, start, windows and piece of each occurrence. A piece is sent as it is, or window by window if its hash is very
    common. What is sent, ordered by shard: contents, buckets, lengths and the smallest document of each in owners. windows_of
    tells for each window of each piece (piece k from first[k] on) what it was sent in (parts) and as which window of that
    (offsets).
    """

    def __init__(self, pack: _Pack, state: np.ndarray, shards: int):
        size, texts = pack.size, pack.texts
        some = np.flatnonzero(state)
        text, start, windows = (x[some].astype(np.int32) for x in (pack.text, pack.start, pack.windows))
        number: dict[bytes, int] = {}  # the content decides the hash, and the hash how it is sent
        told, setdefault = [raw for _, raw in texts], number.setdefault
        asked = zip(text.tolist(), start.tolist(), (start + windows + (size - 1)).tolist(), strict=True)
        piece = np.fromiter((setdefault(told[t][a:e], len(number)) for t, a, e in asked), np.int32, len(some))
        self.at = text, start, windows, piece
        ids = np.array([d for d, _ in texts], np.int64)
        # texts stand in the order of their identifiers, so a piece's first occurrence has its smallest
        _, once = np.unique(piece, return_index=True)
        least = ids[text[once]] if len(once) else np.zeros(0, np.int64)
        key, common = pack.key[some][once], state[some][once] == 2
        self.count = windows[once].astype(np.int64)
        self.common = np.flatnonzero(common)
        contents = list(number)
        owner: dict[bytes, int] = {}
        place: dict[bytes, int] = {}
        self.single: list[int] = []
        for k in self.common.tolist():
            content, d = contents[k], int(least[k])
            for x in (content[i : i + size] for i in range(len(content) - size + 1)):
                self.single.append(place.setdefault(x, len(place)))
                owner[x] = min(d, owner.get(x, d))
        whole = np.flatnonzero(~common)
        key = np.concatenate([key[whole], np.fromiter(map(xxhash.xxh64_intdigest, owner), np.uint64, len(owner))])
        bucket = (((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        self.place = np.empty(len(order), np.int32)
        self.place[order] = np.arange(len(order))
        every = [*(contents[k] for k in whole.tolist()), *owner]
        self.contents, self.buckets = [every[k] for k in order.tolist()], bucket[order]
        self.lengths = np.concatenate([self.count[whole] + (size - 1), np.full(len(owner), size)])[order]
        self.owners = np.concatenate([least[whole], np.fromiter(owner.values(), np.int64, len(owner))])[order]

    def by_shard(self) -> Iterator[tuple[int, slice]]:
        shards, first = np.unique(self.buckets, return_index=True)
        for b, i, j in zip(shards.tolist(), first.tolist(), np.append(first, len(self.buckets))[1:].tolist(), strict=True):
            yield b, slice(i, j)

    @cached_property
    def windows_of(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """first, parts and offsets."""
        first = np.cumsum(self.count) - self.count
        whole = np.ones(len(self.count), bool)
        whole[self.common] = False
        part = np.zeros(len(self.count), np.int32)
        part[whole] = self.place[: int(whole.sum())]
        parts = np.repeat(part, self.count)
        offsets = (np.arange(len(parts)) - np.repeat(first, self.count)).astype(np.int32)
        alone = np.repeat(~whole, self.count)
        parts[alone] = self.place[int(whole.sum()) + np.array(self.single, np.int64)]
        offsets[alone] = 0
        return first, parts, offsets


def _asked(right: pa.Table, kind: int) -> dict[int, bytes]:
    return {b: x for k, b, x in zip(*(right.column(c).to_pylist() for c in ("kind", "bucket", "told")), strict=True) if k == kind}


def _copies(right: pa.Table) -> set[tuple[int, bytes]]:
    """(identifier, digest of the text): other texts of the identifier are no copies."""
    return {(x["id"], x["print"]) for k, ids in zip(right.column("kind").to_pylist(), right.column("ids").to_pylist(), strict=True) if k == 0 for x in ids}


def _repeated(p: _Pack, right: pa.Table, ranges: int) -> np.ndarray:
    """Per distinct hash: 0 in one document only, 1 repeated, 2 repeated very often."""
    keys, told = p.keys[0], _asked(right, 1)
    out = np.zeros(len(keys), np.uint8)
    for bucket, s in by_range(keys, ranges):
        out[s] = np.frombuffer(told[bucket], np.uint8)
    return out


def _table(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(schema)], names=[n for n, _ in schema])


SENT = [("bucket", pa.int32()), ("pack", pa.int32()), ("data", pa.binary()), ("lengths", pa.binary()), ("owners", pa.binary())]
SENT_SQL = "bucket int, pack int, data binary, lengths binary, owners binary"
ANSWER = [("pack", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("ids", pa.list_(pa.struct([("id", pa.int64()), ("print", pa.binary())]))), ("told", pa.binary())]


def _hashes(ranges: int, size: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            keys, others, _ = _Pack(left, _copies(right), size).keys
            pack = left.column("pack")[0].as_py()
            for bucket, s in by_range(keys, ranges):
                rows.append((bucket, pack, keys[s].tobytes(), np.minimum(others[s], 65_535).astype(np.uint16).tobytes(), None))
        return _table(SENT, rows)

    return run


def _judged(table: pa.Table) -> pa.Table:
    """Which hashes of one range occur in two documents, told to each pack that sent them."""
    keys = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("data")]
    others = np.concatenate([np.frombuffer(x.as_py(), np.uint16) for x in table.column("lengths")])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(place, others + 1.0, minlength=len(distinct))
    state = (n > 1).astype(np.uint8) + (n > HOT)
    told = np.split(state.astype(np.uint8)[place], np.cumsum([len(k) for k in keys])[:-1])
    return _table(ANSWER, [(p, 1, b, [], x.tobytes()) for p, b, x in zip(table.column("pack").to_pylist(), table.column("bucket").to_pylist(), told, strict=True)])


def _cut_out(ranges: int, shards: int, size: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            p = _Pack(left, _copies(right), size)
            pieces = p.pieces(_repeated(p, right, ranges), shards)
            pack = left.column("pack")[0].as_py()
            for b, s in pieces.by_shard():
                rows.append((b, pack, b"".join(pieces.contents[s]), pieces.lengths[s].astype(np.uint16).tobytes(), pieces.owners[s].tobytes()))
        return _table(SENT, rows)

    return run


def owners_of_windows(contents: list[bytes], owner: np.ndarray, size: int) -> np.ndarray:
    """For each window of each content, one after another: the smallest owner of any content that has the same window."""
    lengths = np.array([len(c) for c in contents])
    text = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8)
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    ends = np.zeros(len(text), bool)
    ends[starts + lengths] = True
    present = np.flatnonzero(np.bincount(text[~ends], minlength=256))
    code = np.zeros(256, np.uint8 if len(present) < 253 else np.uint16)
    code[present] = np.arange(len(present)) + 2  # 0 ends the text, 1 ends a piece
    t = np.append(code[text], code.dtype.type(0))
    t[:-1][ends] = 1
    windows = lengths - size + 1
    sa = suffix_array(t)
    same = common_prefixes(t, sa, starts, windows, size)
    piece = np.full(len(t), -1, np.int32)
    at = np.repeat(starts, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    piece[at] = np.repeat(np.arange(len(contents)), windows)
    order = sa[piece[sa] >= 0]
    first = np.flatnonzero(np.concatenate([[True], same[order[1:]] < size]))
    least = np.minimum.reduceat(owner[piece[order]], first)
    by_place = np.empty(len(t), np.int64)
    by_place[order] = np.repeat(least, np.diff(np.append(first, len(order))))
    return by_place[at]


def _sorted_shard(size: int):
    def run(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        asked = []
        for data, lengths, owners in zip(*(table.column(c).to_pylist() for c in ("data", "lengths", "owners")), strict=True):
            length = np.frombuffer(lengths, np.uint16).astype(np.int64)
            ends = np.cumsum(length)
            cuts = zip((ends - length).tolist(), ends.tolist(), strict=True)
            mine = np.fromiter((number.setdefault(data[a:e], len(number)) for a, e in cuts), np.int32, len(length))
            asked.append((mine, np.frombuffer(owners, np.int64)))
        least = np.full(len(number), LAST)
        for mine, own in asked:
            np.minimum.at(least, mine, own)
        contents = list(number)
        number.clear()
        found = owners_of_windows(contents, least, size)
        windows = np.array([len(c) for c in contents]) - size + 1
        first = np.cumsum(windows) - windows
        rows = []
        for p, b, (mine, own) in zip(table.column("pack").to_pylist(), table.column("bucket").to_pylist(), asked, strict=True):
            n = windows[mine]
            at = np.repeat(first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows.append((p, 2, b, [], np.packbits(found[at] < np.repeat(own, n)).tobytes()))
        return _table(ANSWER, rows)

    return run


def _cleaned(ranges: int, shards: int, size: int, kind: pa.DataType, rest: pa.DataType | None):
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + (["rest", "kept"] if rest else [])
    kinds = [kind, pa.int64(), pa.int64(), pa.int64(), pa.string()] + ([rest, pa.string()] if rest else [])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        p = _Pack(left, _copies(right), size)
        pieces = p.pieces(_repeated(p, right, ranges), shards)
        told = _asked(right, 2)
        windows = pieces.lengths - (size - 1)
        bits = np.zeros(int(windows.sum()), bool)
        first = np.cumsum(windows) - windows
        for b, s in pieces.by_shard():
            a, e = first[s.start], first[s.stop - 1] + windows[s.stop - 1]
            bits[a:e] = np.unpackbits(np.frombuffer(told[b], np.uint8), count=int(e - a))
        start_of, parts, offsets = pieces.windows_of
        precedes, owner = bits[first[parts] + offsets] if len(parts) else bits, pieces.owners[parts]
        length = np.array([len(raw) for _, raw in p.texts], np.int64)
        base = np.cumsum(length + 1) - (length + 1)
        edge = np.zeros(int((length + 1).sum()) + 1, np.int32)
        ids = np.array([d for d, _ in p.texts], np.int64)
        for i in range(0, len(pieces.at[0]), CHUNK):
            text, start, n, piece = (x[i : i + CHUNK] for x in pieces.at)
            rows = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            window = start_of[piece[rows]] + step
            # the owner is another pack's document, or an earlier one of this pack
            gone = precedes[window] | (owner[window] < ids[text[rows]])
            where = (base[text[rows]] + start[rows] + step)[gone]  # each window once
            edge[where] += 1
            edge[where + size] -= 1
        cut = np.cumsum(edge) > 0
        out: dict[tuple[int, bytes], tuple] = {}
        for (d, raw), a, n in zip(p.texts, base.tolist(), length.tolist(), strict=True):
            mask = cut[a : a + n]
            removed = int(mask.sum())
            kept = np.frombuffer(raw, np.uint8)[~mask].tobytes() if removed else raw
            spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
            out[d, raw] = n, removed, spans, hashlib.sha256(kept).hexdigest(), kept
        made = []
        for (d, raw), gone in zip(p.rows, p.copied, strict=True):
            if gone:
                made.append((len(raw), len(raw), 1, EMPTY, b""))
            else:
                made.append(out.get((d, raw)) or (len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
        cols = [left.column("id"), *(pa.array([m[i] for m in made], kinds[i + 1]) for i in range(4))]
        if rest:  # a cut inside a character takes the character
            cols += [left.column("rest"), pa.array([m[4].decode("utf-8", "ignore") for m in made], pa.string())]
        return pa.table(cols, names=names)

    return run


def _plan(docs: DataFrame, id_col: str, text_col: str, size: int, keep: bool) -> DataFrame:
    if not GRAM <= size <= 512 or docs.schema[id_col].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError("size must be 16 to 512 and the identifier an integer")
    texts, n = dealt(docs.withColumn(id_col, F.col(f"`{id_col}`").cast("bigint")), id_col, text_col, PACK, keep)
    lean = texts.select("pack", "id", "raw")
    # copies of a smaller document, by pack
    # never NULL, or else the join's filter for that would go below the shuffle of the texts and make it a second one
    print_ = F.coalesce(F.unhex(F.sha2("raw", 256)), F.lit(bytearray()))
    prints = texts.select("pack", F.coalesce("id", F.lit(LAST)).alias("id"), print_.alias("print"))
    # a text that many packs hold is one row per pack
    held = prints.groupBy("pack", "print").agg(F.collect_set("id").alias("held"))
    first = held.groupBy("print").agg(F.min(F.array_min("held")).alias("first"), F.max(F.array_max("held")).alias("last")).filter("first < last")
    later = F.filter("held", lambda x: x > F.col("first"))
    ids = F.transform(later, lambda x: F.struct(x.alias("id"), F.col("print").alias("print"))).alias("ids")
    copies = held.join(first, "print").select("pack", ids).groupBy("pack").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    none = lambda kind: [F.lit(kind).alias("kind"), F.lit(-1).alias("bucket")]
    copies = copies.select(F.col("pack").alias("pack"), *none(0), "ids", F.lit(None).cast("binary").alias("told"))
    by = lambda df: df.groupBy("pack")
    hashes = by(lean).cogroup(by(copies)).applyInArrow(_hashes(n, size), SENT_SQL)
    known = hashes.repartition(partitions(n), "bucket").groupBy("bucket").applyInArrow(_judged, TOLD)
    shards = 2 * n
    pieces = by(lean).cogroup(by(copies.unionByName(known))).applyInArrow(_cut_out(n, shards, size), SENT_SQL)
    owners = pieces.repartition(partitions(shards), "bucket").groupBy("bucket").applyInArrow(_sorted_shard(size), TOLD)
    kinds = texts.limit(0).select("id", *(["rest"] if keep else [])).toArrow().schema
    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema += f", rest {texts.schema['rest'].dataType.simpleString()}, kept string" if keep else ""
    last = _cleaned(n, shards, size, kinds.field("id").type, kinds.field("rest").type if keep else None)
    return by(texts).cogroup(by(copies.unionByName(known).unionByName(owners))).applyInArrow(last, schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return _plan(docs, id_col, text_col, size, False).withColumnRenamed("id", "doc_id")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50) -> DataFrame:
    """The documents with repeated passages cut out of the text, a column n_chars counted anew, the others as they are."""
    rows = _plan(docs, id_col, text_col, size, True)
    new = {text_col: F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return rows.select(*(new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))
