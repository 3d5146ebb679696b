"""License scans by diagonal voting.

Every rolling word k-gram of a document is hashed and joined with the k-grams of the templates. A match at document
word p and template word t votes for diagonal p - t. An undisturbed copy of a template puts all its votes on one diagonal;
inserted or lost words move the rest to a neighbouring one, so neighbouring diagonals are merged, over as many words as the
template has k-grams. A span is then verified word by word: its coverage is the longest run of k-grams that follow each other both in
the document and in the template, each template position counted once, so a repeated fragment counts once.

Defined cases: NULL or empty text has no words and no labels; rows that are repeated in full give one output row
each; the template table is fixed and small (about a hundred k-grams), so its broadcast has a bound that does not depend on
the data. A document's matches are aggregated under its own key, so no key holds more than one document's matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.llm.text import LETTERED, ascii_lower, words

#: Phrases that count wherever their words stand consecutively.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices that count when most of their k-grams agree.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license you may obtain a copy of the license": "apache-2",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "this work is licensed under a creative commons attribution": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the rights "
    "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
    "whom the software is furnished to do so subject to the following conditions the above copyright notice and this "
    "permission notice shall be included in all copies or substantial portions of the software": "mit",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "isc",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd",
}
DOC, TEMPLATE = ["doc_id", "n_words", "text_hash"], ["template", "label", "base", "n_grams"]


def templates(spark: SparkSession, gram: int = 3) -> DataFrame:
    """One row per k-gram of a template: template, label, base, n_grams, at, gram, hash."""
    rows = []
    for base, table in ((True, PHRASES), (False, NOTICES)):
        for text, label in table.items():
            w = text.split()
            n = len(w) - gram + 1
            rows += [(text, label, base, n, t, " ".join(w[t : t + gram])) for t in range(n)]
    df = spark.createDataFrame(rows, "template string, label string, base boolean, n_grams int, at int, gram string")
    return df.withColumn("hash", F.xxhash64(*(F.split("gram", " ")[i] for i in range(gram))))


def diagonals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = 3) -> DataFrame:
    """Votes by document, template and diagonal, and one row without template for each document.

    Columns: doc_id, n_words, text_hash, template, label, base, n_grams, diagonal, votes, first, last (document words of the
    first and last vote), seen (the template positions that voted). On the row without template, votes is the number of rows with this identifier and text.
    """
    split = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        words(F.col(text_col), LETTERED).alias("w"),
    )
    n = F.size("w")
    rolling = F.arrays_zip(*(F.slice("w", i + 1, F.greatest(n, F.lit(1))).alias(f"w{i}") for i in range(gram)))
    # entry 0 stands for the document itself, so that one pass carries both its matches and its size
    marker = F.array(F.struct(*(F.lit(None).cast("string").alias(f"w{i}") for i in range(gram))))
    grams = split.select("doc_id", n.alias("n_words"), "text_hash", F.posexplode(F.concat(marker, rolling)).alias("pos", "g"))
    parts = [F.col(f"g.w{i}") for i in range(gram)]
    # lower() is the fast way but changes other letters too: the comparison of texts after the join sorts those out
    probe = grams.withColumn("hash", F.when(parts[-1].isNotNull(), F.xxhash64(*(F.lower(p) for p in parts))))
    found = probe.join(F.broadcast(templates(docs.sparkSession, gram)), "hash", "left")
    same = ascii_lower(F.concat_ws(" ", *parts)) == F.col("gram")
    kept = found.filter((F.col("pos") == 0) | (F.col("gram").isNotNull() & same))
    at = F.col("pos") - 1
    return kept.groupBy(*DOC, *TEMPLATE, (at - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min(at).alias("first"), F.max(at).alias("last"), F.collect_set("at").alias("seen")
    )


def _in_order(pairs: Column, n_grams: Column) -> Column:
    """Most pairs (p, -t) with p and t both rising.

    Goes through the pairs by p, the larger t first, and keeps for each t the longest run that ends at t or before; as long
    as the template, whatever the number of pairs.
    """
    def longer(best: Column, pair: Column) -> Column:
        t = -pair["t"]
        run = F.when(t > 0, F.try_element_at(best, t)).otherwise(F.lit(0)) + 1  # what ends before t
        return F.transform(best, lambda b, i: F.when(i >= t, F.greatest(b, run)).otherwise(b))

    return F.element_at(F.aggregate(F.array_sort(pairs), F.array_repeat(F.lit(0), n_grams), longer), -1)


def spans(votes: DataFrame, gram: int = 3, shift: int = 3, coverage: float = 0.6) -> DataFrame:
    """License spans from the votes of `diagonals`, and the documents' own rows as they are.

    Diagonals of one template that differ by at most `shift` are one span, which ends after as many diagonals as the template has
    k-grams. Columns: the document's, the template's, first_word, last_word (its last), places (undisturbed copies), coverage (share
    of the template's k-grams found in order, at most 1), accepted (coverage reached; a phrase needs an undisturbed copy).
    """
    by = W.partitionBy(*DOC, *TEMPLATE).orderBy("diagonal")
    new = F.col("diagonal") - F.lag("diagonal").over(by) > shift
    merged = votes.withColumn("chain", F.sum(F.when(new, 1).otherwise(0)).over(by))
    start = F.min("diagonal").over(W.partitionBy(*DOC, *TEMPLATE, "chain"))
    merged = merged.withColumn("span", F.struct("chain", F.floor((F.col("diagonal") - start) / F.col("n_grams")).alias("part")))
    # repeated rows vote alike
    copies = F.first(F.when(F.col("template").isNull(), F.col("votes")), True).over(W.partitionBy(*DOC))
    merged = merged.withColumn("copies", copies)
    merged = merged.withColumn("votes", F.when(F.col("template").isNotNull(), F.expr("votes div copies")).otherwise(F.col("votes")))
    full = F.col("votes") == F.col("n_grams")
    found = merged.groupBy(*DOC, *TEMPLATE, "span").agg(
        F.min("first").alias("first_word"), (F.max("last") + gram - 1).alias("last_word"),
        F.count(F.when(full, 1)).alias("places"),
        F.min(F.when(full, F.col("diagonal"))).alias("first_place"), F.max(F.when(full, F.col("diagonal"))).alias("last_place"),
        F.flatten(F.collect_list(F.transform("seen", lambda t: F.struct((t + F.col("diagonal")).alias("p"), (-t).alias("t"))))).alias("pairs"),
        F.first("copies").alias("copies"),
    )
    found = found.withColumn("coverage", F.when(F.col("n_grams").isNotNull(), _in_order(F.col("pairs"), F.col("n_grams")) / F.col("n_grams")))
    accepted = F.when(F.col("base"), F.col("places") > 0).otherwise(F.coalesce(F.col("coverage") >= coverage, F.lit(False)))
    return found.withColumn("accepted", accepted)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of all documents (see `spans`)."""
    return spans(diagonals(docs, id_col, text_col))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = scan(docs)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    base = F.col("base") & F.col("accepted")
    rows = found.groupBy(*DOC).agg(
        F.coalesce(F.sum(F.when(F.col("base"), F.col("places"))), F.lit(0)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_place"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("last_place"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("accepted")).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"), F.max("copies").alias("copies"),
    )
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
