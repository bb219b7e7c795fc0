"""Near-duplicates of texts whose word shingles have a Jaccard similarity (the pipeline's near-dedup stage).

Texts of equal sets fall together first. The sets' SimHash fingerprints are joined in tries (``simhash``), and
those links are candidates: each is verified on the whole sets. Fingerprints can't show all pairs at the
threshold, so an exact way for the rest follows, for sets that the verified links leave apart: a set-similarity
join as in ``lines``. Each text's shingles are ordered by rarity, from a corpus-wide count of a bounded number
of hash buckets, then by hash; only prefixes are joined, under the length, prefix and positional filters, and
every pair that stays is verified likewise, so no pair is missed and none is linked below the threshold. A set
is first held against one holder of each of its prefix tokens; the join of all holders then leaves out pairs
that earlier links connect, so a large group of near copies costs links, not pairs. Before whole sets are fetched, pairs pass a filter by
signatures: a set's is a bitmap of the parities of its hashes' counts, and the bits in which two differ are at
most the elements that are in one set only, so no similar pair is lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statuta.llm.common import connected_components, lean, likely, materialize
from statuta.llm.lines import _close, _pairs, least

#: Hash buckets whose counts order shingles by rarity, and bits of a signature.
BUCKETS, SIGNATURE = 1 << 16, 1024


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The distinct hashes of a text's word shingles, ascending; of fewer words: of the whole text."""
    from xxhash import xxh64_intdigest

    w = (text or b"").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    each = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else iter([b" ".join(w)])
    return np.unique(np.fromiter(map(xxh64_intdigest, each, repeat(42)), np.uint64, count=max(1, len(w) - words + 1)))


def _set_id(h: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(h.tobytes(), 7)).view(np.int64))


def _lists(each: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
    flat = np.concatenate(each).view(np.int64) if each else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def rarity(texts: DataFrame, words: int) -> np.ndarray:
    """For each bucket a level, 0 to 1023, that rises with the count of its shingles in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for t in b.column(1):
                np.add.at(count, (shingles(t.as_py(), words) % np.uint64(BUCKETS)).astype(np.int64), 1)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], ["b", "n"])

    total = np.zeros(BUCKETS, np.int64)
    for r in texts.mapInArrow(lean(run), "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        total[r["b"]] = r["n"]
    return np.minimum(1023, np.round(24 * np.log2(total + 1))).astype(np.uint64)


def prefixes(texts: DataFrame, words: int, t: float, levels: np.ndarray, sketch: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """doc_id, sid (hash of the set), n (its size), fps (its sketch), sig (its signature), prefix: its rarest tokens, as many as t asks for, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(x.as_py(), words) for x in b.column(1)]
            cut = []
            for h in sets:
                key = np.sort((levels[(h % np.uint64(BUCKETS)).astype(np.int64)] << np.uint64(53)) | (h >> np.uint64(11)))
                cut.append(key[: len(h) - math.ceil(t * len(h) - 1e-9) + 1])
            ids = pa.array([_set_id(h) for h in sets], pa.int64())
            odd = [np.bincount((h >> np.uint64(20)).astype(np.int64) % SIGNATURE, minlength=SIGNATURE) & 1 for h in sets]
            sig = _lists([np.packbits(x.astype(bool)).view(np.uint64) for x in odd])
            yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array([len(h) for h in sets], pa.int32()), _lists([sketch(h) for h in sets]), sig, _lists(cut)], ["doc_id", "sid", "n", "fps", "sig", "prefix"])

    return texts.mapInArrow(lean(run), "doc_id long, sid long, n int, fps array<long>, sig array<long>, prefix array<long>")


def _likely_similar(pairs: DataFrame, heads: DataFrame, t: float) -> DataFrame:
    """The pairs (x, y) of set ids whose signatures leave room for the similarity."""
    of = lambda c: heads.select(F.col("sid").alias(c), F.col("n").alias(f"{c}n"), F.col("sig").alias(f"{c}s"))
    both = pairs.join(of("x"), "x").join(of("y"), "y")
    apart = F.aggregate(F.zip_with("xs", "ys", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, v: s + v)
    n = F.col("xn") + F.col("yn")
    return both.where(F.floor((n - apart) / 2) >= least(t / (1 + t), n)).select("x", "y")


def _similar(pairs: DataFrame, texts: DataFrame, known: DataFrame, words: int, t: float) -> DataFrame:
    """The pairs (x, y) of set ids whose whole sets, read again from the texts of their first documents, are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(x.as_py(), words) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([_set_id(h) for h in sets], pa.int64()), _lists(sets)], ["sid", "set"])

    sids = pairs.select(F.col("x").alias("sid")).unionByName(pairs.select(F.col("y").alias("sid"))).distinct()
    wanted = materialize(sids.join(known, "sid"))
    ids = wanted.select(F.col("v").alias("doc_id")).distinct()
    of = likely(texts, ids, ["doc_id"]).join(ids, "doc_id", "left_semi").select("doc_id", "text")
    whole = of.mapInArrow(lean(run), "sid long, set array<long>").join(wanted.select("sid"), "sid", "left_semi")
    whole = materialize(whole.dropDuplicates(["sid"]))
    both = pairs.join(whole.select(F.col("sid").alias("x"), F.col("set").alias("u")), "x").join(whole.select(F.col("sid").alias("y"), F.col("set").alias("v")), "y")
    return both.where(F.size(F.array_intersect("u", "v")) >= least(t / (1 + t), F.size("u") + F.size("v"))).select("x", "y")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs (x, y) that the components (v, component) don't connect."""
    of = lambda c: label.select(F.col("v").alias(c), F.col("component").alias(f"{c}c"))
    both = pairs.join(of("x"), "x", "left").join(of("y"), "y", "left")
    return both.where(F.coalesce("xc", "x") != F.coalesce("yc", "y")).select("x", "y")


def components(docs: DataFrame, words: int, t: float, sketch: Callable[[np.ndarray], np.ndarray], candidates: Callable[[DataFrame], DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, component_id: for each id the smallest that it reaches by links of similarity t or more.

    sketch gives the fingerprints of a set's hashes, candidates the links (a, b) of sets (v, fps) by them. Null texts are empty, and texts without words are copies of one another. Rows with a null id are left
    out; rows that repeat an id are one id, so whatever any of them links to is shared.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).where(F.col("doc_id").isNotNull())
    rows = materialize(prefixes(texts, words, t, rarity(texts, words), sketch))
    known = rows.groupBy("sid").agg(F.min("doc_id").alias("v"))
    heads = materialize(rows.where("n > 0").groupBy("sid").agg(*[F.first(c).alias(c) for c in ("n", "fps", "sig", "prefix")]))
    linked = candidates(heads.select(F.col("sid").alias("v"), "fps"))
    linked = materialize(linked.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct())
    close = materialize(_similar(materialize(_likely_similar(linked, heads, t)), texts, known, words, t))
    label = connected_components(close, "x", "y")
    # flat rows are moved; structs are made where they arrive
    postings = heads.select(F.col("sid").alias("id"), "n", F.posexplode("prefix").alias("i", "tok")).repartition("tok")
    postings = postings.select("tok", F.struct("id", "n", "i").alias("x"))
    by_token = Window.partitionBy("tok")
    shared = postings.withColumn("y", F.min("x").over(by_token)).withColumn("top", F.max("x.id").over(by_token))
    shared = materialize(shared.where("top <> y.id").select("tok", "x", "y"))

    first = materialize(_pairs(shared.where((F.col("x.id") != F.col("y.id")) & _close("x", "y", t)), t))
    more = _apart(first, label).join(linked, ["x", "y"], "left_anti")
    sure = materialize(close.unionByName(_similar(materialize(_likely_similar(more, heads, t)), texts, known, words, t)))
    label = connected_components(sure, "x", "y")
    held = shared.select("tok", "x", F.col("x.id").alias("__v")).join(label.withColumnRenamed("v", "__v"), "__v", "left")
    held = held.select("tok", "x", F.coalesce("component", "__v").alias("c"))
    other = held.select("tok", F.col("x").alias("y"), F.col("c").alias("d"))
    rest = held.join(other, "tok").where((F.col("y.id") < F.col("x.id")) & (F.col("c") != F.col("d")) & _close("x", "y", t))
    # a pair of a first holder or of the tries has been judged on whole sets above
    judged = first.unionByName(linked)
    rest = materialize(_likely_similar(_pairs(rest, t).join(judged, ["x", "y"], "left_anti"), heads, t))
    found = sure.unionByName(_similar(rest, texts, known, words, t))

    head = lambda c, v: known.select(F.col("sid").alias(c), F.col("v").alias(v))
    edges = found.join(head("x", "a"), "x").join(head("y", "b"), "y").select("a", "b")
    edges = edges.unionByName(rows.select("doc_id", "sid").join(known, "sid").where("doc_id <> v").select(F.col("doc_id").alias("a"), F.col("v").alias("b")))
    label = connected_components(edges)
    return rows.select("doc_id").distinct().join(label.withColumnRenamed("v", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component_id"))
