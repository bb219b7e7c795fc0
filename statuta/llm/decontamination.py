"""Benchmark decontamination by greedy string tiling (operator 5).

Documents and items share seeds: runs of ``least`` words, the shortest tile. Seeds of documents that may be an
item's, by a bitmap of fixed size, are joined with the items' seeds. Every tiled word lies in a shared seed, so
what a pair shares must be able to cover the share of the item that makes a leak; for the same reason an item's
most common seeds need no join, as long as they alone can't cover that share. For each pair that is left,
running Karp-Rabin finds the longest matches of unmarked words, marks them, and goes on with shorter ones down
to ``least`` words, so that a passage whose parts stand in another order is still covered. An item of which at
least ``coverage`` is tiled is a leak.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.llm.common import lean, likely, table, unlikely, written

#: Words of the shortest tile and of a seed, and the share of an item's words that makes a leak.
LEAST, COVERAGE = 3, 0.5
#: Words of 64 bits in the bitmap of the items' seeds, and parts to which the holders of a seed are dealt.
BITMAP, PARTS = 1 << 16, 16

#: Bytes that end a word, as spaces: those of ASCII but letters and digits.
_WORDS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_MULTIPLIER = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_WORDS).split() if text else []


def word_hashes(text: str | None) -> np.ndarray:
    from xxhash import xxh64_intdigest

    w = words(text)
    return np.fromiter(map(xxh64_intdigest, w, repeat(5)), np.uint64, count=len(w))


class Runs:
    """Karp-Rabin hashes, modulo 2**64, of all runs of n words, for any n, from sums over prefixes."""

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids)
        power = np.full(n + 1, _MULTIPLIER, np.uint64)
        power[:1] = 1
        self.power = np.multiply.accumulate(power)
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
        mixed ^= mixed >> np.uint64(32)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed * np.uint64(0xBF58476D1CE4E5B9) * self.power[:n], out=self.sums[1:])
        self.size = n

    def of(self, n: int) -> np.ndarray:
        """All runs, raised to one power so that equal runs have equal hashes wherever they stand."""
        count = self.size - n + 1
        if count <= 0:
            return np.empty(0, np.uint64)
        h = (self.sums[n:] - self.sums[:-n]) * _inverse_powers(count)
        return h ^ (h >> np.uint64(29))


_INVERSE = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _INVERSE
    if len(_INVERSE) < n:
        p = np.full(max(n, 2 * len(_INVERSE)), pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
        p[0] = 1
        _INVERSE = np.multiply.accumulate(p)
    return _INVERSE[:n]


def _free(ok: np.ndarray, n: int) -> np.ndarray:
    """Whether the n words from each place on may be matched."""
    total = np.concatenate([[0], np.cumsum(ok)])
    return total[n:] - total[:-n] == n if len(ok) >= n else np.empty(0, bool)


def tile(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiles (start in a, start in b, length) of two arrays of word numbers; 0 matches nothing.

    Longest first; ties go to the smaller start in a, then in b. Tiles have at most about sqrt(2 len(a))
    different lengths; each costs a binary search with a pass over both texts a step, and a pass in which
    places that are taken are left behind for good, so repetitive texts take no longer than others.
    """
    run_a, run_b = Runs(a), Runs(b)
    free_a, free_b, tiles = a > 0, b > 0, []

    def shared(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Free starts in a whose run of n words has a hash that a free run of b has too; free starts in b; their hashes."""
        at_a, at_b = np.flatnonzero(_free(free_a, n)), np.flatnonzero(_free(free_b, n))
        hash_b = run_b.of(n)[at_b]
        return at_a[np.isin(run_a.of(n)[at_a], hash_b)], at_b, hash_b

    top = min(len(a), len(b))
    while top >= least:
        low, high = least - 1, top  # a shared run of n words has shared runs of fewer
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if len(shared(mid)[0]) else (low, mid - 1)
        n = low
        if n < least:
            break
        at_a, at_b, hash_b = shared(n)
        order = np.argsort(hash_b, kind="stable")
        hash_b, at_b, hash_a = hash_b[order], at_b[order], run_a.of(n)
        begin, end = np.searchsorted(hash_b, hash_a[at_a]), np.searchsorted(hash_b, hash_a[at_a], side="right")
        reached: dict[int, int] = {}
        for i, lo, hi in zip(at_a.tolist(), begin.tolist(), end.tolist()):
            if not free_a[i : i + n].all():
                continue
            k = reached.get(lo, lo)
            while k < hi and not free_b[at_b[k] : at_b[k] + n].all():
                k += 1
            reached[lo] = k  # taken words stay taken
            while k < hi:
                j = int(at_b[k])
                if free_b[j : j + n].all() and np.array_equal(a[i : i + n], b[j : j + n]):
                    free_a[i : i + n] = free_b[j : j + n] = False
                    tiles.append((i, j, n))
                    break
                k += 1
        top = n - 1
    return sorted(tiles)


def tiled(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles of an item's and a document's word hashes; only words of shared seeds are looked at."""
    ids, a = np.unique(item, return_inverse=True)
    at = np.minimum(np.searchsorted(ids, doc), len(ids) - 1)
    b = np.where(ids[at] == doc, at + 1, 0)
    a = a + 1
    hit = np.flatnonzero(_free(b > 0, least))
    hit = hit[np.isin(Runs(b).of(least)[hit], Runs(a).of(least))]
    keep = np.zeros(len(b) + 1, bool)
    for k in range(least):
        keep[hit + k] = True
    keep = keep[:-1]
    place = np.flatnonzero(keep)
    if not len(place):
        return []
    # what lies between is one word that matches nothing
    gap = np.concatenate([[False], np.diff(place) > 1])
    short = np.insert(b[place], np.flatnonzero(gap), 0)
    where = np.insert(place, np.flatnonzero(gap), -1)
    return [(i, int(where[j]), n) for i, j, n in tile(a, short, least)]


def _distinct(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, rk, text: rows and a hash that tells apart texts under one id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("rk"), text.alias("text"))


def _seeds(items: DataFrame, least: int) -> DataFrame:
    """item, n (its words), seed, weight (its words that the seed covers at most) of items (item, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1)):
                w = word_hashes(text.as_py())
                seed, times = np.unique(Runs(w).of(least), return_counts=True)
                rows += [(item, len(w), s, least * t) for s, t in zip(seed.view(np.int64).tolist(), times.tolist())]
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], ["item", "n", "seed", "weight"])

    return items.mapInArrow(run, "item long, n long, seed long, weight long")


def _hits(docs: DataFrame, bitmap: object, least: int) -> DataFrame:
    """id, rk, seed: the different seeds of each document (id, rk, text) that the bitmap of the items' seeds has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = bitmap.value
        for b in batches:
            found, at = [], []
            for k, text in enumerate(b.column(2)):
                seed = Runs(word_hashes(text.as_py())).of(least)
                bit = seed % np.uint64(64 * BITMAP)
                seed = np.unique(seed[(mask[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0])
                found.append(seed)
                at.append(np.full(len(seed), k))
            row = pa.array(np.concatenate(at) if at else np.empty(0, np.int64), pa.int64())
            seeds = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(seeds)], ["id", "rk", "seed"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(lean(run), f"id {kind}, rk long, seed long")


def _found(docs: DataFrame, benchmark: DataFrame, least: int, coverage: float, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame | None:
    """id, rk, item_id, n_item, n_tiled, n_tiles for each document and different item that leaks into it; None without items."""
    spark = docs.sparkSession
    items = _distinct(benchmark, item_col, item_text).withColumnsRenamed({"id": "item_id", "rk": "item_rk"}).groupBy("item_id", "item_rk", "text").agg(F.count("*").alias("copies"))
    items = written(items.withColumn("item", F.monotonically_increasing_id()), "items")
    seeds = written(_seeds(items.select("item", "text"), least), "seeds")
    slot = F.pmod("seed", F.lit(64 * BITMAP))  # as the unsigned remainder, for a power of two
    bits = seeds.groupBy(F.shiftright(slot, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(seed, {64 * BITMAP}) % 64 as int))")).alias("m")).collect()  # BITMAP rows at most
    if not bits:
        return None
    mask = np.zeros(BITMAP, np.int64)
    for r in bits:
        mask[r["w"]] = r["m"]
    rows = _distinct(docs, id_col, text_col)
    hits = written(_hits(rows, spark.sparkContext.broadcast(mask.view(np.uint64)), least), "hits")

    # an item's most common seeds that can't make a leak by themselves aren't joined
    held = hits.groupBy("seed").agg(F.count("*").alias("held"))
    upto = F.sum("weight").over(Window.partitionBy("item").orderBy(F.col("held").desc(), "seed"))
    ranked = seeds.join(held, "seed").withColumn("need", F.ceil(F.col("n") * coverage - 1e-9)).withColumn("upto", upto)
    slack = F.coalesce(F.max(F.when(F.col("upto") < F.col("need"), F.col("upto"))).over(Window.partitionBy("item")), F.lit(0))
    rare = ranked.withColumn("slack", slack).where("upto >= need").select("seed", "item", "weight", (F.col("need") - F.col("slack")).alias("least"))
    rare = rare.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    pairs = hits.withColumn("part", F.pmod("rk", F.lit(PARTS)).cast("int")).join(rare, ["seed", "part"])
    pairs = pairs.groupBy("id", "rk", "item").agg(F.sum("weight").alias("got"), F.first("least").alias("least")).where("got >= least")
    wanted = pairs.join(items, "item").groupBy("id", "rk").agg(F.collect_list(F.struct("item_id", "copies", F.col("text").alias("words"))).alias("items"))
    wanted = written(wanted, "pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, at = [], []
            for k, (text, held) in enumerate(zip(b.column(2), b.column(3))):
                doc = word_hashes(text.as_py())
                for x in held.as_py():
                    item = word_hashes(x["words"])
                    tiles = tiled(item, doc, least)
                    covered = sum(t[2] for t in tiles)
                    if covered >= coverage * len(item):
                        found.append((x["item_id"], x["copies"], len(item), covered, len(tiles)))
                        at.append(k)
            item_id, *rest = zip(*found) if found else ((),) * 5
            at = pa.array(at, pa.int64())
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(item_id, b.column(3).type.value_type.field("item_id").type), *(pa.array(x, t) for x, t in zip(rest, kinds))], ["id", "rk", "item_id", "copies", "n_item", "n_tiled", "n_tiles"])

    at = wanted.withColumnsRenamed({"id": "__id", "rk": "__rk"})
    both = likely(rows, wanted, ["id", "rk"]).join(at, F.col("id").eqNullSafe(F.col("__id")) & (F.col("rk") == F.col("__rk"))).select("id", "rk", "text", "items")
    kind, item_kind = rows.schema["id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    return both.mapInArrow(lean(run), f"id {kind}, rk long, item_id {item_kind}, copies long, n_item int, n_tiled int, n_tiles int")


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, n_item, n_tiled, n_tiles, coverage: a row for each document and item that leaks into it.

    Words are runs of ASCII letters, digits and other characters beyond ASCII, lower-cased. Null and empty texts
    leak nothing; an item of fewer than ``least`` words has no room for a tile, so it can't leak. Repeated
    documents and items each give their rows, ids may be null, either table may be empty, and other columns are
    not read. Whole texts are searched, and each document's text is read twice whatever the benchmark's size.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    found = _found(docs, benchmark, least, coverage, id_col, text_col, item_col, item_text)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, item_id {item_kind}, n_item int, n_tiled int, n_tiles int, coverage double")
    found = found.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_item", "n_tiled", "n_tiles", (F.col("n_tiled") / F.col("n_item")).alias("coverage"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs into which nothing leaks, with all their columns; nulls and repeats as in ``leaks``.

    Only rows that may be among those that leak, by a bitmap of fixed size, are moved.
    """
    found = _found(docs, benchmark, least, coverage, id_col, text_col, item_col, item_text)
    if found is None:
        return docs
    bad = written(found.select("id", "rk").distinct(), "leaks")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("rk"))
    at = bad.withColumnsRenamed({"id": "__id", "rk": "__rk"})
    kept = likely(rows, bad, ["id", "rk"]).join(at, F.col("id").eqNullSafe(F.col("__id")) & (F.col("rk") == F.col("__rk")), "left_anti")
    return unlikely(rows, bad, ["id", "rk"]).unionByName(kept).select("__doc.*")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
