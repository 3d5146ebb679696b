"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has one bit per position of the 64-bit hashes of a text's word shingles: 1 where over half of them are 1. Two
texts are linked when their fingerprints differ in at most `most` bits.

1. Bits that vary together are grouped into the same partition (greedily, by their correlation over all fingerprints), so
   that the other partitions stay selective.
2. Each fingerprint gets its own thresholds t_i >= -1 with sum most - parts + 1: if all partitions differed by more
   than their thresholds, the whole would differ by more than `most`. Dynamic programming picks the thresholds
   with the fewest expected candidates; counts are estimated from histograms of small slices of each partition.
3. A fingerprint probes, per partition, all values within its threshold; what it meets is verified in full.

Buckets with many members are not joined, as that would make pairs of all their members. Their fingerprints go
to an exact linear way instead: each is put down under its 65 variants with at most one changed bit. Two fingerprints at
distance 2 or less share a variant, and all that share one are at distance 2 or less; a variant has 65 members at most.
That way holds for most = 2; for other distances such buckets are joined like the rest.

Equal fingerprints are one node throughout, so exact copies of any number make no links.

Defined cases: NULL, empty and blank texts have fingerprint zero, linked like any other; a text with fewer words than
a shingle is one shingle; repeated rows give one row each; a NULL identifier is kept and never a component's name unless
alone. No driver or task holds more than 64 x 64 bit counts, the slices' histograms (2,304 rows at most), or one batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.components import components
from holdfast.sources.storage import ensure_checkpoint_dir

BITS, BLOCK = 64, 65_536
SEED = 42


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """Unsigned fingerprint of UTF-8 text."""
    w = raw.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False)) if len(w) >= shingle else [b" ".join(w)]
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, BLOCK):
        ones += np.unpackbits(h[i : i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, print): the fingerprint as a signed long."""
    lean = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in b.column(1)), np.uint64, len(b))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made.view(np.int64))], names=["id", "print"])

    return lean.mapInArrow(run, f"id {lean.schema['id'].dataType.simpleString()}, print bigint")


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(prints: DataFrame, parts: int) -> list[list[int]]:
    """Bits of each partition: correlated bits together, sizes as equal as can be."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        for b in batches:
            x = _bits(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)).astype(np.float32)
            both += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([both.astype(np.int64).ravel().tolist()])], names=["both"])

    sums = (
        prints.select("print").mapInArrow(count, "both array<bigint>").select(F.posexplode("both").alias("i", "n"))
        .groupBy("i").agg(F.sum("n").alias("n")).collect()
    )
    both = np.zeros(BITS * BITS)
    for r in sums:
        both[r.i] = r.n
    n, both = max(1, prints.count()), both.reshape(BITS, BITS)
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    like = np.abs(both / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(like, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        rest = sorted(free)
        own = [max(rest, key=lambda i: like[i, rest].max())]
        while len(own) < size:
            own.append(max((i for i in rest if i not in own), key=lambda i: like[i, own].sum()))
        free -= set(own)
        groups.append(sorted(own))
    return groups


class Plan:
    """Partitions of the bits, histograms of their slices, and what follows from them."""

    def __init__(self, prints: DataFrame, most: int, parts: int, slice_bits: int = 8):
        self.most, self.groups = most, bit_groups(prints, parts)
        self.masks = [sum(1 << b for b in g) for g in self.groups]
        self.slices = [[g[i : i + slice_bits] for i in range(0, len(g), slice_bits)] for g in self.groups]
        flat = [s for g in self.slices for s in g]

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros((len(flat), 1 << slice_bits), np.int64)
            for b in batches:
                x = _bits(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
                for k, s in enumerate(flat):
                    held[k] += np.bincount(self._value(x, s), minlength=1 << slice_bits)
            k, v = np.nonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(v), pa.array(held[k, v])], names=["k", "v", "n"])

        rows = prints.select("print").mapInArrow(count, "k bigint, v bigint, n bigint").groupBy("k", "v").agg(F.sum("n").alias("n"))
        held = np.zeros((len(flat), 1 << slice_bits))
        for r in rows.collect():
            held[r.k, r.v] = r.n
        self.n = max(1.0, held[0].sum())
        apart = np.array([i.bit_count() for i in range(1 << slice_bits)])[np.arange(1 << slice_bits)[:, None] ^ np.arange(1 << slice_bits)]
        # near[k][v][d]: share of all fingerprints whose slice k is d bits away from v
        self.near = [np.stack([(h * (apart == d)).sum(1) / self.n for d in range(most + 1)], 1) for h in held]

    @staticmethod
    def _value(x: np.ndarray, bits: list[int]) -> np.ndarray:
        return x[:, bits].astype(np.int64) @ (1 << np.arange(len(bits)))

    def balls(self, part: int) -> list[np.ndarray]:
        """Changes of the partition's bits within each threshold from 0 to most."""
        out, bits = [], [1 << b for b in self.groups[part]]
        for t in range(self.most + 1):
            out.append(np.array([sum(c) for k in range(t + 1) for c in combinations(bits, k)], np.uint64))
        return out

    def thresholds(self, prints: np.ndarray) -> np.ndarray:
        """One threshold per fingerprint and partition (-1: not probed), by dynamic programming."""
        x, n = _bits(prints), len(prints)
        room = self.most + 1  # sum of (threshold + 1) over the partitions
        cost, k = [], 0
        for part, slices in enumerate(self.slices):
            share = np.zeros((n, room))
            share[:, 0] = 1
            for s in slices:
                own = self.near[k][self._value(x, s)]
                share = np.stack([sum(share[:, i] * own[:, d - i] for i in range(d + 1)) for d in range(room)], 1)
                k += 1
            probes = np.array([len(b) for b in self.balls(part)])
            cost.append(np.concatenate([np.zeros((n, 1)), share.cumsum(1) * self.n + probes], 1))
        best, taken = np.full((n, room + 1), np.inf), []
        best[:, 0] = 0
        for c in cost:
            ways = np.stack(
                [np.stack([best[:, j - e] + c[:, e] if e <= j else np.full(n, np.inf) for e in range(room + 1)], 1) for j in range(room + 1)], 1
            )
            taken.append(ways.argmin(2))
            best = ways.min(2)
        at, out = np.full(n, room), np.zeros((n, len(cost)), np.int64)
        for part in range(len(cost) - 1, -1, -1):
            e = taken[part][np.arange(n), at]
            out[:, part], at = e - 1, at - e
        return out


def _probes(prints: DataFrame, plan: Plan) -> DataFrame:
    """(space, part, key, print): the values that each fingerprint probes."""
    balls = [plan.balls(p) for p in range(len(plan.groups))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            space = b.column(1).to_numpy(zero_copy_only=False)
            chosen = plan.thresholds(x.view(np.int64))
            for part, mask in enumerate(plan.masks):
                for t in range(plan.most + 1):
                    mine = chosen[:, part] == t
                    own, times = x[mine], len(balls[part][t])
                    if len(own):
                        keys = ((own & np.uint64(mask))[:, None] ^ balls[part][t]).ravel().view(np.int64)
                        cols = [np.repeat(space[mine], times), np.full(len(keys), part, np.int32), keys, np.repeat(own, times).view(np.int64)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["space", "part", "key", "print"])

    return prints.select("print", "space").mapInArrow(run, "space int, part int, key bigint, print bigint")


def _variants(prints: DataFrame) -> DataFrame:
    """(variant, print): each fingerprint and its 64 neighbours at distance one."""
    changes = F.array(F.lit(0).cast("long"), *(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(BITS)))
    return prints.select("space", "print", F.explode(F.transform(changes, lambda c: F.col("print").bitwiseXOR(c))).alias("variant"))


def links(prints: DataFrame, most: int = 2, parts: int = 3, light: int = 64) -> DataFrame:
    """(space, a, b): links enough to connect all distinct fingerprints of a space at `most` or fewer differing bits.

    prints: distinct (space, print), cheap to read again (checkpointed); spaces are kinds of fingerprints that are not
    compared with each other. Buckets of up to `light` members are joined and verified pair by pair; larger ones go the linear
    way (see above) and give stars instead of all pairs.
    """
    plan = Plan(prints, most, parts)
    masks = F.array(*(F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("long") for m in plan.masks))
    index = prints.select("space", F.posexplode(masks).alias("part", "mask"), "print")
    key = ["space", "part", "key"]
    index = index.select("space", "part", F.col("print").bitwiseAND(F.col("mask")).alias("key"), "print")
    probes = _probes(prints, plan)
    size = index.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    few = size if most != 2 else size.filter(F.col("n") <= light)
    met = probes.join(index.join(few, key).select(*key, F.col("print").alias("other")), key)
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("other")))
    pairs = met.filter((F.col("print") != F.col("other")) & (apart <= most)).select("space", F.col("print").alias("a"), F.col("other").alias("b"))
    if most != 2:
        return pairs
    many = size.filter(F.col("n") > light).select(*key)
    crowded = probes.unionByName(index).join(many, key, "left_semi").select("space", "print").distinct()
    groups = _variants(crowded).groupBy("space", "variant").agg(F.collect_set("print").alias("all")).filter(F.size("all") > 1)
    stars = groups.select("space", F.array_min("all").alias("a"), F.explode("all").alias("b")).filter("a <> b")
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 2) -> DataFrame:
    """(id, print, component): component is the smallest id reachable over links, the row's own included."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = fingerprints(docs, id_col, text_col, shingle).checkpoint()
    nodes = rows.groupBy("print").agg(F.min("id").alias("least")).withColumn("space", F.lit(0)).checkpoint()
    roots = components(links(nodes, most).select("a", "b"))
    placed = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    names = placed.groupBy("root").agg(F.min("least").alias("component"))
    known = placed.select("print", "root").join(names, "root").select("print", "component")
    return rows.join(known, "print").select("id", "print", "component")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    found = near_duplicates(docs)
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def _digest(text_col: str):
    """Tells texts apart; NULL is not the empty text."""
    return F.coalesce(F.sha2(F.col(f"`{text_col}`").cast("binary"), 256), F.lit(""))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 2) -> DataFrame:
    """One document of each group of `near_duplicates`, that with the smallest identifier, all columns as they are.

    A NULL identifier comes after all others; of texts under one identifier that with the smallest digest stays. Rows are judged
    by identifier and text: an unlike text under the identifier of a copy stays, and of rows equal in both one stays. Texts without
    words have one fingerprint and are one group. An empty table stays empty.
    """
    name, digest = F.col(f"`{id_col}`"), _digest(text_col)
    row = F.struct(name.isNull().alias("none"), name.alias("id"), digest.alias("digest")).alias("row")
    found = near_duplicates(docs.select(row, F.col(f"`{text_col}`").alias("text")), "row", "text", shingle, most)
    gone = found.filter(F.col("id") != F.col("component")).select(F.col("id.id").alias("gone_id"), F.col("id.digest").alias("gone_digest"))
    told = docs.withColumn("__digest", digest)
    left = told.join(gone.distinct(), name.eqNullSafe(F.col("gone_id")) & (F.col("__digest") == F.col("gone_digest")), "left_anti")
    return left.dropDuplicates([id_col, "__digest"]).select(*(F.col(f"`{c}`") for c in docs.columns))
