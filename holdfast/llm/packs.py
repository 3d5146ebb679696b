"""Packs of documents and an exchange of keys between them.

Operators that need a fact about every n-gram or substring of a text would have to shuffle one row for each. Instead documents are
dealt to packs of some megabytes; a pack's task sends its distinct keys, sorted, as one array per range of keys; the range's
task joins the arrays of all packs and answers each with one value per key, in the same order. A key that a third of all
documents hold is one entry per pack. Packs are a hash shuffle of the documents, which Spark reuses for every
step of one query.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.text import total_bytes

PACK_BYTES = 12 << 20
#: Shuffle partitions at most: beyond, a partition holds several packs, which its task takes one after another.
PARTITIONS = 1 << 15


def dealt(docs: DataFrame, id_col: str, text_col: str, pack_bytes: int = PACK_BYTES, keep: bool = False) -> tuple[DataFrame, int]:
    """(pack, id, raw) shuffled by pack, and the number of packs. raw: UTF-8 bytes, NULL as empty.

    With keep, the column rest holds the documents' columns but for the text.
    """
    rest = [F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("rest")] if keep else []
    raw = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    lean = docs.select(F.col(f"`{id_col}`").alias("id"), raw.alias("raw"), *rest)
    n = max(1, ceil(total_bytes(lean, "raw") / pack_bytes))
    pack = F.pmod(F.xxhash64("id", "raw"), F.lit(n)).cast("int")
    return lean.select(pack.alias("pack"), *lean.columns).repartition(partitions(n), "pack"), n


def partitions(groups: int) -> int:
    """Shuffle partitions for a number of packs or ranges."""
    return min(groups, PARTITIONS)


def by_range(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """Sorted unsigned keys cut into equal ranges of their upper 32 bits; empty ranges are left out."""
    if not len(keys):
        return
    place = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(place)) + 1
    edges = np.concatenate([[0], cuts, [len(keys)]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(place[a]), slice(a, b)


def shortened(keys: np.ndarray) -> bytes:
    """Sorted unsigned keys as their first one and the steps between them, in as many bytes as the longest step takes."""
    steps = np.diff(keys)
    width = max(1, -(-int(steps.max(initial=0)).bit_length() // 8))
    return keys[:1].tobytes() + bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def lengthened(raw: bytes) -> np.ndarray:
    """The keys of `shortened`."""
    width = raw[8]
    n = (len(raw) - 9) // width
    out = np.zeros((n + 1, 8), np.uint8)
    out[0] = np.frombuffer(raw, np.uint8, 8)
    out[1:, :width] = np.frombuffer(raw, np.uint8, n * width, 9).reshape(-1, width)
    return np.cumsum(out.view(np.uint64).ravel(), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
