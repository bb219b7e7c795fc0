"""Reports on extraction and identification: page classes, flags, summaries, precision and recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.quality import needs_recognition


def page_classes(pages: DataFrame, doc: str, text: str) -> DataFrame:
    """doc, n_pages, n_ocr, class: text without pages that need recognition, scanned if all do, else mixed."""
    need = needs_recognition(F.col(text))["need"]
    out = pages.groupBy(doc).agg(F.count("*").alias("n_pages"), F.count_if(need).alias("n_ocr"))
    return out.withColumn("class", F.when(F.col("n_ocr") == 0, "text").when(F.col("n_ocr") == F.col("n_pages"), "scanned").otherwise("mixed"))


def prf(gold: DataFrame, predicted: DataFrame, key: list[str], digits: int = 6) -> DataFrame:
    """One row: tp, fp, fn, precision, recall, f1 of distinct keys; a share of nothing is 0."""
    g = gold.select(*key).distinct().withColumn("__g", F.lit(1))
    p = predicted.select(*key).distinct().withColumn("__p", F.lit(1))
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    both = g.join(p, key, "full_outer").agg(n(F.col("__g").isNotNull() & F.col("__p").isNotNull()).alias("tp"), n(F.col("__g").isNull()).alias("fp"), n(F.col("__p").isNull()).alias("fn"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, fp, fn = map(F.col, ("tp", "fp", "fn"))
    precision, recall = share(tp, tp + fp), share(tp, tp + fn)
    return both.select("tp", "fp", "fn", F.round(precision, digits).alias("precision"), F.round(recall, digits).alias("recall"), F.round(share(2 * precision * recall, precision + recall), digits).alias("f1"))


def summary(records: DataFrame) -> DataFrame:
    """One row over validation records (file, identified, error, n_flags, n_provisions)."""
    ok = F.coalesce("identified", F.lit(False))
    return records.agg(
        F.countDistinct("file").alias("documents"), F.count("*").alias("instruments"), F.count_if(ok).alias("identified"), F.count_if(~ok & F.col("error").isNull()).alias("review"),
        F.count_if(F.col("error").isNotNull()).alias("errors"), F.count_if(F.col("n_flags") > 0).alias("flagged"), F.coalesce(F.sum("n_provisions"), F.lit(0)).alias("provisions"),
    )


def flags(provisions: DataFrame, instruments: DataFrame, short: int = 25, share: float = 0.3) -> DataFrame:
    """instrument_id, flags: what speaks against an instrument's extraction.

    provisions: instrument_id, chunk_type, article_no, text, chunk_index. instruments: instrument_id, identified, ocr_degraded.
    """
    article = F.col("chunk_type") == "article"
    odd = F.col("text").rlike("[A-Za-z][Α-Ωα-ωΆ-ώ]|[Α-Ωα-ωΆ-ώ][A-Za-z]")
    seen = provisions.groupBy("instrument_id").agg(
        F.count_if(article).alias("n"), F.countDistinct(F.when(article, F.col("article_no"))).alias("numbers"),
        F.count_if(article & (F.char_length(F.trim("text")) < short)).alias("short"), F.count_if((F.col("chunk_index") < 5) & odd).alias("odd"),
    )
    x = instruments.join(seen, "instrument_id", "left").fillna(0, ["n", "numbers", "short", "odd"])
    rules: list[tuple[Column, str]] = [
        (F.col("n") == 0, "no_articles"), (F.col("n") > F.col("numbers"), "duplicate_articles"), (F.col("short") > share * F.col("n"), "short_bodies"),
        (F.col("odd") > 0, "homoglyphs"), (~F.coalesce("identified", F.lit(False)), "unresolved"), (F.coalesce("ocr_degraded", F.lit(False)), "ocr_degraded"),
    ]
    return x.select("instrument_id", F.array_compact(F.array(*[F.when(c, F.lit(f)) for c, f in rules])).alias("flags"))
