"""Incremental runs: micro-batches of files or edges, upserted and folded as they come.

The store's tables are what carries state: contents already done are skipped, edges whose law hasn't
come yet stay pending and resolve in a later batch, and only provisions that a batch touches are folded
again. ``foreachBatch`` may repeat a batch after a failure; keyed upserts make that harmless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statuta.functions import keys
from statuta.operators import timeline
from statuta.sources.files import Store

EDGE_KEY = ["source_law", "target_id", "action", "ordinal"]


def edge_batch(store: Store) -> Callable[[DataFrame, int], None]:
    """A handler of batches of edges (source_law, target_id, action, ordinal, effective_date, text) that keeps the table of versions current."""

    def handle(batch: DataFrame, number: int) -> None:
        store.upsert("amendments", batch.dropDuplicates(EDGE_KEY), EDGE_KEY)
        consolidate(store, batch)

    return handle


def consolidate(store: Store, touched: DataFrame | None = None) -> None:
    """Fold the stored edges; with ``touched`` only those of its provisions. A second run changes nothing.

    A late edge moves windows, so the versions of a folded article replace all that it had.
    """
    edges, articles, documents = (store.read(n) for n in ("amendments", "articles", "documents"))
    if edges is None or documents is None or articles is None:
        return
    aids = None
    if touched is not None:
        aids = touched.select(keys.article_level(F.col("target_id")).alias("aid")).distinct()
        edges = edges.join(aids.withColumnRenamed("aid", "__aid"), keys.article_level(F.col("target_id")) == F.col("__aid"), "left_semi")
    versions, _ = timeline.assemble(edges, articles, documents)
    store.replace("versions", versions, ["aid"], aids)


def stream_edges(spark: SparkSession, folder: str, schema: str, store: Store, checkpoint: str, **options: str) -> StreamingQuery:
    """Read new Parquet files of edges as they come, once each, and fold them."""
    rows = spark.readStream.schema(schema).options(**options).parquet(folder)
    return rows.writeStream.foreachBatch(edge_batch(store)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def activity(spark: SparkSession, folder: str, schema: str, late: str = "1 day", size: str = "1 day") -> DataFrame:
    """Streaming counts of edges by day of effect and action; rows later than the watermark are left out."""
    rows = spark.readStream.schema(schema).parquet(folder).withColumn("at", F.col("effective_date").cast("timestamp"))
    return rows.withWatermark("at", late).groupBy(F.window("at", size), "action").agg(F.count("*").alias("n"))
