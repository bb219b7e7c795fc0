"""License scans by diagonal voting, with DataFrame operations only (operator 2).

All rolling ``K``-grams of words of every text are hashed and joined with those of license templates, of any
length (a table that is given, broadcast; a phrase of two words has pairs). A hit, checked word by word, votes
for its diagonal: word position less template position. Neighbouring diagonals whose places meet are merged, so
that a missing or an added word does not break a span; a span is verified by the share of its template's words
that its matches cover. A phrase that stands word for word is a diagonal with all its votes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.llm.common import ascii_lower, table

# Phrases whose places count as base ones, and notices by which the method adds labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under cc by nc 4 0": "cc",
    "licensed under a creative commons attribution license": "cc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
#: Words of a gram.
K = 3
#: Diagonals, and words between places, that merge at least; shares of a template's length that do (one in so many).
SHIFT, GAP, SHIFT_PART, GAP_PART = 2, 6, 16, 4
#: Share of a template's words that makes a label.
COVER = 0.7
#: What stands before a text's first word, so that each text has a row: no word has it.
MARK = "\x01"


def template_words(text: str) -> list[str]:
    """As words of documents are made: A-Z lower-cased, runs of ASCII letters, digits and characters beyond ASCII."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """t, tpos, g (words of the gram), k, votes, n_template, phrase, label: the grams of all templates. Bounded by what is given."""
    rows = [(-1, 0, [MARK], 1, 1, 1, True, "")]
    for t, (text, label) in enumerate([*phrases.items(), *notices.items()]):
        w = template_words(text)
        if len(w) < 2:
            raise ValueError(f"a template needs two words or more: {text!r}")
        k = min(K, len(w))
        rows += [(t, i, w[i : i + k], k, len(w) - k + 1, len(w), t < len(phrases), label) for i in range(len(w) - k + 1)]
    return spark.createDataFrame(rows, "t int, tpos int, g array<string>, k int, votes int, n_template int, phrase boolean, label string")


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None, cover: float = COVER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans: a row for every row.

    Null texts are empty: no words, no places, no labels, score 0. Rows that repeat an id with another
    text are rows of their own, and rows repeated whole give their row as often. Null ids are kept.
    A template may have any number of words from two on. An empty table gives no rows; other columns are not read.
    """
    t = templates(docs.sparkSession, PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("key"), F.octet_length(text).alias("size"), F.concat(F.array(F.lit(MARK)), words).alias("words"))
    rows = rows.select("doc_id", "key", "size", "words", F.posexplode("words").alias("pos", "word"))
    after = lambda i: F.get("words", F.col("pos") + i)
    grams = F.when(F.col("pos") == 0, F.array(F.xxhash64("word"))).otherwise(F.array(F.xxhash64("word", after(1)), F.xxhash64("word", after(1), after(2))))
    each = t.select("*", *[F.get("g", i).alias(f"g{i}") for i in range(K)])
    each = each.withColumn("hash", F.when(F.col("k") == 1, F.xxhash64("g0")).when(F.col("k") == 2, F.xxhash64("g0", "g1")).otherwise(F.xxhash64("g0", "g1", "g2"))).drop("g")
    same = (F.col("word") == F.col("g0")) & (F.col("g1").isNull() | (after(1) == F.col("g1"))) & (F.col("g2").isNull() | (after(2) == F.col("g2")))
    hits = rows.withColumn("hash", F.explode(grams)).join(F.broadcast(each), "hash").where(same)
    row = ["doc_id", "key", "size"]
    told = ["votes", "n_template", "k", "phrase", "label"]
    votes = hits.groupBy(*row, "t", (F.col("pos") - 1 - F.col("tpos")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("at"),
        F.count("*").alias("times"),
        F.min("pos").alias("lo"),
        F.max("pos").alias("hi"),
        F.max(F.size("words") - 1).alias("n_words"),
        *[F.first(c).alias(c) for c in told],
    )
    by = Window.partitionBy(*row, "t").orderBy("diagonal")
    part = lambda least, share: F.greatest(F.lit(least), (F.col("n_template") / share).cast("int"))
    apart = F.greatest("lo", F.lag("lo").over(by)) - F.least("hi", F.lag("hi").over(by)) > part(GAP, GAP_PART)
    apart = (F.col("t") < 0) | F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(by) > part(SHIFT, SHIFT_PART)) | apart
    votes = votes.withColumn("span", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(by))
    spans = votes.groupBy(*row, "t", "span").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.max("times").alias("times"), F.min("diagonal").alias("first"), F.max("n_words").alias("n_words"), *[F.first(c).alias(c) for c in told])
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda i: F.sequence(i, i + F.col("k") - 1)))))
    spans = spans.withColumn("share", F.when(F.col("t") >= 0, covered / F.col("n_template")).otherwise(0.0))
    place = (F.col("t") >= 0) & F.col("phrase") & (F.size("at") == F.col("votes"))
    good = (F.col("t") >= 0) & F.when(F.col("phrase"), F.size("at") == F.col("votes")).otherwise(F.col("share") >= cover)

    def labels(which):
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    # rows repeated whole vote together: the mark's votes tell how many they are
    out = spans.groupBy(*row).agg(
        F.max(F.when(F.col("t") < 0, F.col("times"))).alias("copies"),
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("first"))).cast("long").alias("last_word"),
        labels(place).alias("base_labels"),
        labels(good).alias("labels"),
        F.coalesce(F.max(F.when(good | ~F.col("phrase"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.count(F.when(good, 1)).alias("n_spans"),
    )
    return out.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "key", "size")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
