"""Scans of document folders, page tables, and the tables of the knowledge store."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions.quality import needs_recognition


def scan(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """path, doc_id (the file's name), folder label, length, content_hash, content of all files below a folder.

    The label is the first folder below the root, ``(root)`` for files that lie in it. Contents are read
    lazily: a query that doesn't use them doesn't load them.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    root = folder.rstrip("/").split("://")[-1].lstrip("/")
    below = F.regexp_extract("path", "(?s)^.*?" + _quoted(root) + "/(.*)$", 1)
    label = F.when(below.contains("/"), F.substring_index(below, "/", 1)).otherwise("(root)")
    return raw.select("path", F.substring_index("path", "/", -1).alias("doc_id"), label.alias("folder"), "length", F.sha2("content", 256).alias("content_hash"), "content")


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def by_folder(paths: DataFrame) -> DataFrame:
    """folder, n_files, paths (sorted), by folder's name. One folder's paths are one list."""
    return paths.groupBy("folder").agg(F.count("*").alias("n_files"), F.sort_array(F.collect_list("path")).alias("paths"))


def pages(files: DataFrame, reader: Callable[[bytes], list[dict]] | None = None) -> DataFrame:
    """doc_id, page, raw_text, tables of scanned files, by a reader of one file's bytes; pdfplumber where it is installed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = reader or _pdfplumber()
        for b in batches:
            rows = [(d, i + 1, p.get("raw_text"), p.get("tables")) for d, c in zip(b["doc_id"], b["content"]) for i, p in enumerate(read(c))]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "raw_text", "tables"])

    return files.select("doc_id", "content").mapInPandas(run, "doc_id string, page int, raw_text string, tables string")


def _pdfplumber() -> Callable[[bytes], list[dict]]:
    try:
        plumber = importlib.import_module("pdfplumber")
    except ImportError as e:
        raise RuntimeError("no reader of PDF files is installed: pass one, or start from a table of pages") from e
    import io

    from statuta.sources.layout import page_text

    def read(content: bytes) -> list[dict]:
        with plumber.open(io.BytesIO(content)) as pdf:
            return [{"raw_text": page_text(pd.DataFrame(p.extract_words(), columns=["text", "x0", "x1", "top"]), float(p.width)), "tables": None} for p in pdf.pages]

    return read


def extract(page_rows: DataFrame, recognised: DataFrame | None = None) -> DataFrame:
    """doc_id, text, class, ocr_pages, corrupt_pages from pages (doc_id, page, raw_text) and what recognition gave (doc_id, page, markdown).

    A page that needs recognition takes its result; without one a corrupt page is left blank and a short one stays.
    """
    p = page_rows.select("doc_id", "page", F.coalesce("raw_text", F.lit("")).alias("raw")).withColumn("q", needs_recognition(F.col("raw")))
    if recognised is not None:
        p = p.join(recognised.select("doc_id", "page", "markdown"), ["doc_id", "page"], "left")
    else:
        p = p.withColumn("markdown", F.lit(None).cast("string"))
    kept = F.when(F.col("q.corrupt"), "").otherwise(F.col("raw"))
    p = p.withColumn("text", F.when(F.col("q.need"), F.coalesce(F.nullif("markdown", F.lit("")), kept)).otherwise(F.col("raw")))
    need = F.count_if(F.col("q.need"))
    out = p.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "text", F.col("q.need").alias("need"), F.col("q.corrupt").alias("corrupt")))).alias("x"), F.count("*").alias("n"), need.alias("need"))
    numbers = lambda c: F.transform(F.filter("x", lambda r: r[c]), lambda r: r["page"])
    full = F.array_join(F.transform(F.filter("x", lambda r: r["text"] != ""), lambda r: r["text"]), "\n\n")
    return out.select("doc_id", full.alias("text"), F.when(F.col("need") == 0, "text").when(F.col("need") == F.col("n"), "scanned").otherwise("mixed").alias("class"), numbers("need").alias("ocr_pages"), numbers("corrupt").alias("corrupt_pages"))


class Store:
    """Tables on Parquet files, partitioned by tenant; each write of a tenant replaces its partition whole.

    A new state is written beside the old one and read back by its version, so no query reads what is being overwritten.
    """

    def __init__(self, spark: SparkSession, root: str, tenant: str = "gr") -> None:
        self.spark, self.root, self.tenant = spark, root.rstrip("/"), tenant

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def versions(self, name: str) -> list[int]:
        fs, at = self._fs(), self._path(name, f"tenant={self.tenant}")
        if not fs.exists(at):
            return []
        found = [s.getPath() for s in fs.listStatus(at)]
        return sorted(int(p.getName()[1:]) for p in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def read(self, name: str) -> DataFrame | None:
        v = self.versions(name)
        return self.spark.read.parquet(f"{self.root}/{name}/tenant={self.tenant}/v{v[-1]}").withColumn("tenant", F.lit(self.tenant)) if v else None

    def write(self, name: str, df: DataFrame, keep: int = 2) -> None:
        v = self.versions(name)
        df.drop("tenant").write.mode("overwrite").parquet(f"{self.root}/{name}/tenant={self.tenant}/v{(v or [0])[-1] + 1}")
        for old in v[: max(0, len(v) + 1 - keep)]:
            self._fs().delete(self._path(name, f"tenant={self.tenant}", f"v{old}"), True)

    def upsert(self, name: str, batch: DataFrame, key: list[str], patch: bool = False) -> None:
        from statuta.operators.store import upsert

        stored = self.read(name)
        self.write(name, batch if stored is None else upsert(stored.drop("tenant"), batch, key, patch))

    def replace(self, name: str, rows: DataFrame, by: list[str], touched: DataFrame | None = None) -> None:
        """Put rows in the place of all stored rows whose key is in ``touched`` (null: of the whole table)."""
        stored = self.read(name)
        if stored is not None and touched is not None:
            rows = stored.drop("tenant").join(touched.select(*by).distinct(), by, "left_anti").unionByName(rows)
        self.write(name, rows)

    def count(self, name: str) -> int:
        """Rows of the tenant; -1 without the table, 0 without the tenant."""
        if not self._fs().exists(self._path(name)):
            return -1
        df = self.read(name)
        return 0 if df is None else df.count()

    def reset(self, name: str) -> int:
        """Wipe the tenant and tell how many rows it had; the table and other tenants stay."""
        n = max(0, self.count(name))
        self._fs().delete(self._path(name, f"tenant={self.tenant}"), True)
        return n


def events(rows: DataFrame) -> DataFrame:
    """One JSON object a row, as text: for ``write.text`` or a log."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
