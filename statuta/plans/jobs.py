"""Jobs over the store: processing documents with their states, validation, consolidation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.operators import quality, store
from statuta.plans import ingest
from statuta.sources.files import Store
from statuta.streaming.ingest import consolidate

STATE = "doc_id string, content_hash string, status string, stage string, error string, confidence double"
TABLES = {"documents": ["law"], "provisions": ["canonical_id"], "amendments": ["source_law", "target_id", "action", "ordinal"], "delegations": ["implementing_id", "enabling_id"], "articles": ["aid", "valid_from"]}


def loaded(k: ingest.Knowledge) -> dict[str, DataFrame]:
    """The store's tables from what issues hold; an edge without a date takes its issue's, and articles begin on theirs."""
    dated = k.instruments.select("instrument_id", F.to_date("fek_date").alias("__date")).dropDuplicates(["instrument_id"])
    edges = k.amendments.join(dated, "instrument_id", "left")
    articles = k.provisions.where("chunk_type = 'article'").join(dated, "instrument_id", "left")
    return {
        "documents": k.instruments.select(F.col("instrument_id").alias("law"), "instrument_key", "instrument_type", "title", "document_category", F.to_date("fek_date").alias("publication_date")),
        "provisions": k.provisions,
        "amendments": edges.select(F.col("instrument_id").alias("source_law"), "source_id", "target_id", "action", "scope", "ordinal", "text", "resolved", F.col("__date").alias("effective_date")),
        "delegations": k.delegations,
        "articles": articles.select(F.col("canonical_id").alias("aid"), F.col("__date").alias("valid_from"), F.coalesce("text_as_enacted", "text_in_force").alias("text")),
    }


def process(s: Store, issues: DataFrame) -> DataFrame:
    """Issues (doc_id, text) that aren't done yet, into the store, and the states they end in.

    An issue whose acts are all known is done with confidence 1, one of which some go to review with 0.8;
    without any it goes to review. Running it again on the same issues changes nothing.
    """
    spark = issues.sparkSession
    rows = issues.withColumn("content_hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    state = s.read("states")
    state = spark.createDataFrame([], STATE) if state is None else state.drop("tenant")
    todo = store.claim(rows, state)
    k = ingest.run(todo)
    held = [df.persist() for df in (k.acts, k.provisions, k.amendments)]  # each feeds several tables; what is lost is computed again
    for name, df in loaded(k).items():
        s.upsert(name, df.dropDuplicates(TABLES[name]), TABLES[name])
    known = k.instruments.select("doc_id").distinct().withColumn("__known", F.lit(True))
    part = k.acts.where("instrument_id is null").select("doc_id").distinct().withColumn("__open", F.lit(True))
    ends = todo.select("doc_id", "content_hash").join(known, "doc_id", "left").join(part, "doc_id", "left")
    ok = F.coalesce("__known", F.lit(False))
    ends = ends.select("doc_id", "content_hash", F.when(ok, "done").otherwise("review").alias("status"), F.lit("load").alias("stage"), F.when(~ok, "not identified").alias("error"), F.when(ok, F.when(F.coalesce("__open", F.lit(False)), 0.8).otherwise(1.0)).alias("confidence"))
    s.upsert("states", ends, ["doc_id"])
    for df in held:
        df.unpersist()
    consolidate(s)
    return s.read("states").drop("tenant")


def validate(issues: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records by instrument, their summary) of issues, without writing anything."""
    k = ingest.run(issues)
    flags = quality.flags(k.provisions.withColumn("text", F.col("text_in_force")), k.acts.select(F.coalesce("instrument_id", F.concat_ws("?", "doc_id", F.col("seq").cast("string"))).alias("instrument_id"), F.col("instrument_id").isNotNull().alias("identified"), F.lit(False).alias("ocr_degraded")))
    counts = k.provisions.groupBy("instrument_id").agg(F.count("*").alias("n_provisions"))
    r = k.acts.select(F.col("doc_id").alias("file"), F.coalesce("instrument_id", F.concat_ws("?", "doc_id", F.col("seq").cast("string"))).alias("instrument_id"), F.col("instrument_id").isNotNull().alias("identified"), F.lit(None).cast("string").alias("error"))
    r = r.join(flags, "instrument_id", "left").join(counts, "instrument_id", "left").withColumn("n_flags", F.coalesce(F.size("flags"), F.lit(0))).fillna(0, ["n_provisions"])
    return r, quality.summary(r)
