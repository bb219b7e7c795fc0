"""Keyed tables on plain files: upsert, patch, claims, states, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def beside(rows: DataFrame, one: DataFrame) -> DataFrame:
    """Rows with the columns of a frame of a single row, such as a global aggregate."""
    return rows.withColumn("__one", F.lit(1)).join(F.broadcast(one.withColumn("__one", F.lit(1))), "__one").drop("__one")


def last_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key: one maximum of a struct a key, combined before the shuffle, so hot keys don't gather."""
    rest = [c for c in rows.columns if c not in key]
    names = [f"__o{i}" for i in range(len(order))]
    best = rows.select(*key, F.struct(*[o.alias(n) for o, n in zip(order, names)], *rest).alias("x")).groupBy(*key).agg(F.max("x").alias("x"))
    return best.select(*key, *[f"x.{c}" for c in rest])


def upsert(stored: DataFrame, batch: DataFrame, key: list[str], patch: bool = False) -> DataFrame:
    """Stored rows with a batch written over them. patch: nulls in the batch leave what is stored."""
    rest = [c for c in stored.columns if c not in key]
    b = batch.select(*key, F.struct(*rest).alias("__new"))
    s = stored.select(*key, F.struct(*rest).alias("__old"))
    both = s.join(b, key, "full_outer")
    take = (lambda c: F.coalesce(f"__new.{c}", f"__old.{c}")) if patch else (lambda c: F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(f"__old.{c}")))
    return both.select(*key, *[take(c).alias(c) for c in rest])


def new_keys(stored: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    return batch.join(stored.select(*key), key, "left_anti")


def patch_existing(stored: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Stored rows with the updates' values where those are neither null nor empty; keys that aren't stored are skipped."""
    changed = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"__{c}") for c in changed])
    types = dict(stored.dtypes)
    value = lambda c: F.nullif(F.col(f"__{c}"), F.lit("")) if types[c] == "string" else F.col(f"__{c}")
    return stored.join(u, key, "left").select(*[F.coalesce(value(c), c).alias(c) if c in changed else F.col(c) for c in stored.columns])


def first_by_hash(docs: DataFrame, id_col: str, content: Column) -> DataFrame:
    """content_hash, id of its first row, n_copies."""
    return docs.select(F.sha2(content, 256).alias("content_hash"), id_col).groupBy("content_hash").agg(F.min(id_col).alias(id_col), F.count("*").alias("n_copies"))


def claim(batch: DataFrame, state: DataFrame) -> DataFrame:
    """The documents of a batch to process: content not done yet, document not in process, one of each content."""
    done = state.where("status = 'done'").select("content_hash").distinct()
    busy = state.where("status = 'processing'").select("doc_id").distinct()
    open_ = batch.join(done, "content_hash", "left_anti").join(busy, "doc_id", "left_anti")
    one = open_.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"))
    return open_.join(one, ["content_hash", "doc_id"], "left_semi")


def set_status(state: DataFrame, changes: DataFrame) -> DataFrame:
    """New status and error always; stage and confidence only where given."""
    c = changes.select("doc_id", *[F.col(x).alias(f"__{x}") for x in ("status", "stage", "error", "confidence")])
    hit = F.col("__status").isNotNull()
    return state.join(c, "doc_id", "left").select(*[
        F.when(hit, F.col(f"__{x}")).otherwise(F.col(x)).alias(x) if x in ("status", "error") else F.coalesce(f"__{x}", x).alias(x) if x in ("stage", "confidence") else F.col(x)
        for x in state.columns
    ])


def requeue_stale(state: DataFrame) -> DataFrame:
    return state.withColumn("status", F.when(F.col("status") == "processing", "pending").otherwise(F.col("status")))


def pending(state: DataFrame) -> DataFrame:
    """What waits, then what is to be reviewed."""
    return state.where("status = 'pending'").unionByName(state.where("status = 'review'"))


def counts(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count("*").alias("n"))


def laws(rows: DataFrame, law: str, order: str, *texts: str) -> DataFrame:
    """law, n_chunks and the first non-empty of each text by order; rows without a law are skipped."""
    r = rows.where(F.coalesce(F.trim(law), F.lit("")) != "")
    first = [F.min_by(F.nullif(F.col(t), F.lit("")), F.when(F.coalesce(t, F.lit("")) != "", F.col(order))).alias(t) for t in texts]
    return r.groupBy(law).agg(F.count("*").alias("n_chunks"), *first)


def denormalise(sources: DataFrame, edges: DataFrame, source: str, target: str, name: str) -> DataFrame:
    """Sources with the sorted distinct targets of their edges; empty without any."""
    lists = edges.where(F.col(target).isNotNull()).groupBy(source).agg(F.sort_array(F.collect_set(target)).alias(name))
    kind = lists.schema[name].dataType
    return sources.join(lists, source, "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))


def find(rows: DataFrame, conditions: Column, order: list, limit: int = 2000) -> DataFrame:
    return rows.where(conditions).orderBy(*order).limit(limit)


def tenant_reset(spark, path: str, schema, tenant: str) -> None:
    """Wipe one tenant of a table that is partitioned by tenant; its schema and the other tenants stay."""
    empty = spark.createDataFrame([], schema).where("false")
    if any(f.name == "tenant" for f in schema):
        for status in _partitions(spark, path, tenant):
            _delete(spark, status)
        return
    empty.write.mode("overwrite").parquet(path)


def _partitions(spark, path: str, tenant: str) -> list[str]:
    return [f"{path}/tenant={tenant}"]


def _delete(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ranked(df: DataFrame, by: list[str], order: list) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
