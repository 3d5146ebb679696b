"""Language-model scores by deleted interpolation.

P(w | h) = a c(h w) / c(h) + b c(w) / N + d / (V + 1), with weights a, b, d for each class of how often the context h occurs
(powers of two). The weights are learned by expectation-maximisation on held-out counts: each training bigram is taken out of
the counts before it is predicted (c - 1), so all training text serves as held-out text once. Its probabilities enter a histogram
of a bounded number of cells, on which the iterations run.

Counts of all words and bigrams pass between packs of documents as sorted arrays of hashes (see `packs`); the plan is one
query, and the shuffles of documents and counts are used three times.

Defined cases: NULL or empty text is its end token only; a NULL identifier counts as empty text in the split (training);
repeated rows are counted and scored each; with no training text N and V are 0 and every token has probability 1 / (V + 1).
Base scores use the same counts.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.packs import by_range, dealt, lengthened, mix, partitions, shortened

START, END = b" start", b" end"  # no word has a space
FOLDS, HELD_OUT = 7, 2
CLASSES, BINS, STEPS = 24, 96, 40
REPLY = "pack int, bucket int, uni binary, bi binary, tokens bigint, types bigint"


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


class _Pack:
    """Tokens of a pack's documents as numbers, and its distinct words and bigrams as sorted hashes."""

    def __init__(self, table: pa.Table):
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__
        start, end = number[START], number[END]
        self.ids, self.held, flows = [], [], []
        for d, raw in zip(table.column("id"), table.column("raw"), strict=True):
            w = raw.as_py().lower().split()
            flow = np.empty(len(w) + 2, np.int32)
            flow[0], flow[-1] = start, end
            flow[1:-1] = np.fromiter(map(number.__getitem__, w), np.int32, len(w))
            self.ids.append(d.as_py())
            self.held.append(held_out(d.as_py()))
            flows.append(flow)
        size = np.array([len(f) - 1 for f in flows], np.int64)
        self.size = size
        self.word = np.concatenate([f[1:] for f in flows])
        context = np.concatenate([f[:-1] for f in flows])
        self.train = np.repeat(~np.array(self.held, bool), size)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), np.uint64, len(number))
        self.uni, place = np.unique(hashes, return_inverse=True)
        self.word, self.context = place[self.word], place[context]
        pair = (self.context.astype(np.int64) << 32) | self.word
        pairs, self.bigram = np.unique(pair, return_inverse=True)
        with np.errstate(over="ignore"):
            keys = mix(self.uni[pairs >> 32] * np.uint64(0x9E3779B97F4A7C15) + self.uni[pairs & 0xFFFFFFFF])
        order = np.argsort(keys)
        self.bi = keys[order]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.bigram = back[self.bigram]
        self.start = int(np.searchsorted(self.uni, hashes[start]))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of words (the start as often as training documents) and bigrams."""
        uni = np.bincount(self.word[self.train], minlength=len(self.uni))
        uni[self.start] += len(self.held) - sum(self.held)
        return uni, np.bincount(self.bigram[self.train], minlength=len(self.bi))


def _sent(ranges: int):
    def run(table: pa.Table) -> pa.Table:
        p = _Pack(table)
        rows: dict[int, list[bytes]] = defaultdict(lambda: [b"", b"", b"", b""])
        for at, (keys, n) in enumerate(zip((p.uni, p.bi), p.counts(), strict=True)):
            for bucket, s in by_range(keys, ranges):
                rows[bucket][2 * at : 2 * at + 2] = [shortened(keys[s]), n[s].astype(np.uint32).tobytes()]
        pack = table.column("pack")[0].as_py()
        cols = [pa.array(list(rows), pa.int32()), pa.array([pack] * len(rows), pa.int32())]
        cols += [pa.array([r[i] for r in rows.values()], pa.binary()) for i in range(4)]
        return pa.table(cols, names=["bucket", "pack", "uni", "uni_n", "bi", "bi_n"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """Adds the packs' counts of one range of keys and answers each pack."""
    answers, tokens, types = [], 0, 0
    start = np.uint64(xxhash.xxh64_intdigest(START))
    for name in ("uni", "bi"):
        keys = [lengthened(x.as_py()) if len(x.as_py()) else np.zeros(0, np.uint64) for x in table.column(name)]
        n = [np.frombuffer(x.as_py(), np.uint32) for x in table.column(f"{name}_n")]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(n), minlength=len(distinct)).astype(np.int64)
        if name == "uni":
            words = total[distinct != start]
            tokens, types = int(words.sum()), int((words > 0).sum())
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        answers.append([x.tobytes() for x in np.split(total[place].astype(np.uint32 if total.max(initial=0) < 1 << 32 else np.uint64), cuts)])
    m = table.num_rows
    first = [1] + [0] * (m - 1)  # a range's totals travel with its first answer
    cols = [table.column("pack"), table.column("bucket"), pa.array(answers[0], pa.binary()), pa.array(answers[1], pa.binary())]
    cols += [pa.array([tokens * x for x in first], pa.int64()), pa.array([types * x for x in first], pa.int64())]
    return pa.table(cols, names=["pack", "bucket", "uni", "bi", "tokens", "types"])


def _received(p: _Pack, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All counts of the pack's words and bigrams, from the ranges' answers."""
    order = np.argsort(replies.column("bucket").to_numpy())
    out = []
    for name, keys in (("uni", p.uni), ("bi", p.bi)):
        told = [replies.column(name)[int(i)].as_py() for i in order]
        ends = dict(by_range(keys, int(replies.column("ranges")[0].as_py())))
        names = replies.column("bucket").to_numpy()[order].tolist()
        n = np.zeros(len(keys), np.int64)
        for bucket, raw in zip(names, told, strict=True):
            if bucket in ends:
                s = ends[bucket]
                n[s] = np.frombuffer(raw, np.uint32 if len(raw) == 4 * (s.stop - s.start) else np.uint64)
        out.append(n)
    return out[0], out[1]


def _classes(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(np.float64))[1], CLASSES - 1)


def _bin(p: np.ndarray) -> np.ndarray:
    """Half powers of two; 0 has the last bin of its own."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.minimum(-2 * np.log2(np.maximum(p, 1e-300)), BINS - 2), BINS - 1).astype(np.int64)


def _cells(left: pa.Table, replies: pa.Table) -> pa.Table:
    """Histogram of the pack's training bigrams, each taken out of the counts: class of context, bins of both probabilities."""
    names = ["cell", "n"]
    if not left.num_rows or not replies.num_rows:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64())], names=names)
    p = _Pack(left)
    uni, bi = _received(p, replies)
    own = p.counts()[1]
    first = np.zeros(len(p.bi), np.int64)
    first[p.bigram] = np.arange(len(p.bigram))
    used = own > 0
    h, w, c, own = uni[p.context[first]][used], uni[p.word[first]][used], bi[used], own[used]
    total = max(2, replies.column("total_tokens")[0].as_py())
    cell = (_classes(h - 1) * BINS + _bin((c - 1) / np.maximum(h - 1, 1))) * BINS + _bin((w - 1) / (total - 1))
    cells, place = np.unique(cell, return_inverse=True)
    n = np.bincount(place, own, minlength=len(cells)).astype(np.int64)
    return pa.table([pa.array(cells), pa.array(n)], names=names)


def learned(cells: np.ndarray, n: np.ndarray, types: int) -> np.ndarray:
    """Weights (class, part) by expectation-maximisation on the histogram."""
    low = lambda b: np.where(b == BINS - 1, 0.0, 2.0 ** (-(b + 0.5) / 2))
    c, b2, b1 = cells // (BINS * BINS), cells // BINS % BINS, cells % BINS
    parts = np.stack([low(b2), low(b1), np.full(len(cells), 1.0 / (types + 1))], 1)
    weight = np.tile([0.4, 0.4, 0.2], (CLASSES, 1))
    for _ in range(STEPS):
        share = weight[c] * parts
        share *= (n / share.sum(1))[:, None]
        for k in range(3):
            weight[:, k] = np.bincount(c, share[:, k], minlength=CLASSES) + (1e-3 if k else 0.0)
        weight /= weight.sum(1, keepdims=True)
    weight[0] = [0, weight[0, 1], weight[0, 2]]  # a context that was never seen predicts nothing
    weight[0] /= weight[0].sum()
    return weight


def _model(table: pa.Table) -> pa.Table:
    cells, n = (table.column(x).to_numpy().astype(np.int64) for x in ("cell", "n"))
    weights = learned(cells, n, table.column("total_types")[0].as_py())
    return pa.table([pa.array([weights.ravel().tolist()], pa.list_(pa.float64()))], names=["weights"])


def _scores(kind: pa.DataType):
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [kind, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(left: pa.Table, replies: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        p = _Pack(left)
        uni, bi = _received(p, replies)
        tokens, types = (replies.column(x)[0].as_py() for x in ("total_tokens", "total_types"))
        told = replies.column("weights")[0].as_py()
        weight = np.array(told).reshape(CLASSES, 3) if told else np.tile([0.0, 0.5, 0.5], (CLASSES, 1))
        c, h = uni[p.word], uni[p.context]
        base = np.log10((c + 1) / (tokens + types + 1))
        a, b, d = weight[_classes(h)].T
        probability = a * bi[p.bigram] / np.maximum(h, 1) + b * c / max(tokens, 1) + d / (types + 1)
        score = np.log10(np.maximum(probability if tokens else np.full(len(c), 1 / (types + 1)), 1e-300))
        starts = np.cumsum(p.size) - p.size
        cols = [p.ids, p.held, p.size, np.add.reduceat((c > 0).astype(np.int64), starts), np.full(len(p.ids), tokens), np.add.reduceat(base, starts), np.add.reduceat(score, starts)]
        return pa.table([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], names=names)

    return run


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    texts, n = dealt(docs, id_col, text_col)
    keys = texts.groupBy("pack").applyInArrow(_sent(n), "bucket int, pack int, uni binary, uni_n binary, bi binary, bi_n binary")
    replies = keys.repartition(partitions(n), "bucket").groupBy("bucket").applyInArrow(_added, REPLY).repartition(partitions(n), "pack")
    total = replies.groupBy().agg(F.struct(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.coalesce(F.sum("types"), F.lit(0)).alias("v")).alias("total"))
    told = replies.withColumn("total", total.scalar()).withColumns({"total_tokens": F.col("total.t"), "total_types": F.col("total.v"), "ranges": F.lit(n)}).drop("total", "tokens", "types")
    cells = texts.groupBy("pack").cogroup(told.groupBy("pack")).applyInArrow(_cells, "cell bigint, n bigint")
    cells = cells.groupBy("cell").agg(F.sum("n").alias("n")).withColumn("total_types", total.scalar()["v"])
    # at most CLASSES x BINS x BINS cells, whatever the input
    model = cells.groupBy(F.lit(0).alias("one")).applyInArrow(_model, "weights array<double>")
    told = told.withColumn("weights", model.scalar())
    kind = texts.schema["id"].dataType.simpleString()
    return texts.groupBy("pack").cogroup(told.groupBy("pack")).applyInArrow(
        _scores(texts.limit(0).select("id").toArrow().schema.field(0).type),
        f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and the columns of `scored`."""
    return scored(docs).withColumnRenamed("id", "doc_id")
