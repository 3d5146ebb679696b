"""Quality rules as a short-circuit cascade.

Each rule's cost and share of rejections are measured on a bounded sample; rules then run in order of rejections per cost
inside one CASE, which Spark evaluates lazily: a document that the first rule rejects never pays for the others. The
sample decides the order only; which documents are rejected does not depend on it.

Defined cases: NULL or empty text has no words and fails the word count; texts of any length are measured whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.text import words

#: Bits of a sort key that hold the position of a word: a Spark string has fewer words than that.
PLACE_BITS = 30


@dataclass(frozen=True)
class Rule:
    """A named test that rejects a document: `fails` takes the named measures as columns."""

    name: str
    measures: tuple[str, ...]
    fails: Callable[..., Column]


RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 50),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 50 * n),
    Rule("symbols", ("word_chars", "n_symbols"), lambda c, s: 100 * s > 8 * c),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), lambda n, d: 100 * d > 50 * n),
    Rule("word_length", ("n_words", "word_chars"), lambda n, c: (c < 2 * n) | (c > 20 * n)),
)
BASE = ("few_words", "repeated_words")


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    """Code points outside ASCII white space."""
    return F.length(F.regexp_replace(_text(text), r"[\x20\x09-\x0D]+", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(_text(text), r"[^#*$%&|<>]+", "")).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(_text(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_lines(text: Column) -> Column:
    """Lines that have a word."""
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines that have a word and equal an earlier line."""
    return F.transform(F.array(_lines(text)), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long")


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.transform(F.array(value), body)[0]


def n_repeat_words(text: Column, window: int = 3) -> Column:
    """Words inside windows of words that the text has twice or more, first occurrences included.

    Windows are hashed and sorted with their positions; only neighbours that agree in the hash are then compared as
    text. Long runs cost a sort, not a comparison of pairs.
    """
    mask = (1 << PLACE_BITS) - 1

    def starts(w: Column) -> Column:
        valid = F.slice(w, 1, F.greatest(F.size(w) - (window - 1), F.lit(0)))
        keys = F.transform(
            valid,
            lambda x, i: F.xxhash64(*(F.get(w, i + j) for j in range(window))).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")),
        )
        high = lambda k: k.bitwiseAND(F.lit(~mask))
        near = lambda s, same: F.filter(
            s, lambda x, i: F.coalesce(same(x, F.get(s, i - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, i + 1)), F.lit(False))
        )
        likely = _let(F.sort_array(keys), lambda s: near(s, lambda a, b: high(a) == high(b)))
        told = F.transform(
            likely,
            lambda k: _let(
                k.bitwiseAND(F.lit(mask)).cast("int"),
                lambda p: F.struct(F.concat_ws(" ", *(F.get(w, p + j) for j in range(window))).alias("g"), p.alias("p")),
            ),
        )
        sure = _let(F.sort_array(told), lambda s: near(s, lambda a, b: a["g"] == b["g"]))
        return F.sort_array(F.transform(sure, lambda x: x["p"]))

    def covered(s: Column) -> Column:
        steps = F.transform(s, lambda p, i: F.least(F.coalesce(F.get(s, i + 1) - p, F.lit(window)), F.lit(window)).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return _let(words(text), lambda w: _let(starts(w), covered))


MEASURES = {f.__name__: f for f in (n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)}


def rejects(rule: Rule, text: Column | None = None) -> Column:
    """The rule over measured columns, or over a text whose measures are taken only where the rule is evaluated."""
    values = [F.col(m) if text is None else MEASURES[m](text) for m in rule.measures]
    return F.coalesce(rule.fails(*values), F.lit(False))


def profile(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", rows: int = 300, chars: int = 20_000):
    """Seconds and share of rejections of each rule on a sample of at most `rows` texts of `chars` characters.

    Returns the rules with (seconds, share), ordered by rejections per second. Nothing else depends on the sample.
    """
    spark = docs.sparkSession
    taken = docs.select(F.substring(F.col(text_col), 1, chars).alias("text")).take(rows)
    sample = spark.createDataFrame([(r.text,) for r in taken], "text string").repartition(1).persist()
    n = max(1, sample.count())
    told = []
    for rule in rules:
        began = time.perf_counter()
        share = sample.filter(rejects(rule, F.col("text"))).count() / n
        told.append((rule, time.perf_counter() - began, share))
    sample.unpersist()
    return sorted(told, key=lambda x: (-x[2] / max(x[1], 1e-6), x[0].name))


def cascade(ordered: list[Rule], text: Column | None = None) -> Column:
    """Name of the first rule that rejects, in this order, or NULL; later rules are not evaluated."""
    out = None
    for rule in ordered:
        test = rejects(rule, text)
        out = F.when(test, rule.name) if out is None else out.when(test, rule.name)
    return out


def filtered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The documents that no rule rejects, all columns as they are."""
    ordered = [r for r, _, _ in profile(docs, rules, text_col)]
    return docs.filter(cascade(ordered, F.col(text_col)).isNull())


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept. Which rule rejects first depends on the order found."""
    ordered = [r for r, _, _ in profile(docs, rules)]
    rows = docs.select("doc_id", *(MEASURES[m](F.col("text")).alias(m) for m in MEASURES))
    failed = [rejects(r) for r in rules if r.name in BASE]
    rows = rows.withColumns({"base_failed": failed[0] | failed[1], "kept": cascade(ordered).isNull()})
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
