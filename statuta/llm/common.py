"""What the corpus operators share: tables, cut lineage, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; one under the warehouse where that is unset."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared")
    return named or sc.getCheckpointDir()


#: Whether the shuffle files of a query go as soon as it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Folders that ``written`` made and nobody has removed.
_FOLDERS: list[str] = []


def folders() -> int:
    """How many folders there are: what ``remove_folders`` is told later."""
    return len(_FOLDERS)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_folders(spark: SparkSession, since: int) -> None:
    """Remove what has been written since; for callers that have written the result of all that read it."""
    for folder in _FOLDERS[since:]:
        remove(spark, folder)
    del _FOLDERS[since:]


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The rows, written to the shared folder and read again; what they were shuffled by leaves the disks. With ``folder``, there."""
    spark = df.sparkSession
    at, before = folder or f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", spark.conf.get(_CLEANUP, None)
    if not folder:
        _FOLDERS.append(at)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(at)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(at)


#: Words of 64 bits in the bitmap of wanted keys: its size, whatever their number.
BITMAP = 1 << 17


def _marked(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """rows with __in: whether their key's hash is one of the wanted keys', by a broadcast bitmap of fixed size."""
    place, bit = F.pmod(F.xxhash64(*on, F.lit(1)), F.lit(64 * BITMAP)), F.expr("shiftleft(1L, cast(__h % 64 as int))")
    bitmap = wanted.select(place.alias("__h")).groupBy(F.shiftright("__h", 6).alias("__w")).agg(F.bit_or(bit).alias("__mask"))
    rows = rows.withColumn("__h", place).withColumn("__w", F.shiftright("__h", 6)).join(F.broadcast(bitmap), "__w", "left")
    return rows.withColumn("__in", F.coalesce(F.col("__mask").bitwiseAND(bit) != 0, F.lit(False)))


def likely(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key may be among the wanted ones, where they are; others pass by chance, and all of those wanted pass."""
    return _marked(rows, wanted, on).where("__in").select(*rows.columns)


def unlikely(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows that ``likely`` leaves out: none of their keys is wanted."""
    return _marked(rows, wanted, on).where("not __in").select(*rows.columns)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table in the shared folder."""
    return written(df, "step")


#: What workers hold between tasks.
_HELD: list = []


def held(make: Callable) -> Callable:
    """A function whose values a worker keeps for later tasks, until a lean task that doesn't use them."""
    _HELD.append(lru_cache(maxsize=2)(make))
    return _HELD[-1]


def lean(run: Callable[[Iterator], Iterator], *uses: Callable) -> Callable[[Iterator], Iterator]:
    """A task's function over batches that gives back what memory it freed when it ends: workers live on for other tasks.

    What earlier tasks made the worker hold goes first, but for the ``held`` functions that it uses.
    """

    def whole(batches: Iterator) -> Iterator:
        import ctypes
        import gc

        import pyarrow as pa

        from statuta.llm import common

        for made in common._HELD:
            if made not in uses:
                made.cache_clear()
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return whole


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` does that for texts without other letters."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(v, component): for each vertex of an edge list of long ids, the smallest id it reaches.

    Alternates large-star and small-star steps, each a partial-aggregated minimum joined back to the
    edges, so that no vertex's neighbours are ever gathered. Stops when the edges no longer change;
    only a count and a checksum reach the driver. Null ids are ignored; no edges give no rows.
    """
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    e = materialize(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        return r[0], r[1]

    last = mark(e)
    for _ in range(max_rounds):
        if not last[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        now = mark(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    v = e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("component"))
    return v.unionByName(e.select(F.col("v"), F.col("v").alias("component")).distinct())
