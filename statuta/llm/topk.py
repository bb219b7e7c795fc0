"""Exact top-k by inner product over an impact-ordered, score-at-a-time index (operator 9).

A component's size is its posting's impact, quantised to its number of bits. A block of vectors is indexed by
posting segments: the postings of one dimension and one quantised impact. For a query the segments are
processed by descending impact times the query's component, in tiers whose impacts are within a factor of two,
into accumulators. After each tier, what a vector may still gain is at most the norm of its unprocessed
components times the norm of the query's, so each score is known within bounds. Vectors whose upper bound is
below the k-th lower bound cannot be members; once few may be, or all segments are done, those are rescored
exactly. Nothing is cut off without that proof.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.llm.common import materialize, table, written

#: Queries that are held at a time, and vectors that are indexed together.
QUERIES, BLOCK = 4096, 8192
#: Possible members of a query, in multiples of k or as a share of a block (one in so many), at which rescoring is cheaper than another tier.
FEW, SHARE = 3, 32


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of rows of integers; beyond 64 bits they end at its limits."""
    if len(q) and float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(v.astype(float)).max(initial=0)) * max(1, q.shape[1]) < 2.0**62:
        return (q * v).sum(axis=1)
    wide = (q.astype(object) * v.astype(object)).sum(axis=1)
    return np.array([min(max(int(x), -(2**63)), 2**63 - 1) for x in wide], np.int64)


class Index:
    """The posting segments of a block of integer vectors, each sorted by dimension and quantised impact."""

    def __init__(self, ids: np.ndarray, v: np.ndarray) -> None:
        self.ids, self.v = ids, v
        size = np.abs(v.astype(float))
        vec, dim = np.nonzero(v)
        impact = np.frexp(size[vec, dim])[1]  # the number of bits: a posting of impact i is below 2**i
        order = np.lexsort((-impact, dim))
        self.vec, dim, impact = vec[order], dim[order], impact[order]
        self.value = v[self.vec, dim].astype(float)
        self.begin = np.flatnonzero(np.concatenate([[True], (dim[1:] != dim[:-1]) | (impact[1:] != impact[:-1])])) if len(dim) else np.empty(0, np.int64)
        self.end = np.append(self.begin[1:], len(dim))[: len(self.begin)]
        self.dim, self.impact = dim[self.begin], impact[self.begin]
        self.norm2 = (size**2).sum(axis=1)
        self.processed = self.skipped = 0

    def search(self, q_id: int, q: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of all vectors of other ids that may be among the query's k best; least: a score that k vectors reach already."""
        n, qf = len(self.ids), q.astype(float)
        acc, own = np.zeros(n), self.ids == q_id
        rest_v, rest_q = self.norm2.copy(), np.full(n, (qf**2).sum())
        slack = 1e-9 * np.sqrt(rest_v * rest_q) + 1e-6
        alive = ~own
        used = np.flatnonzero(qf[self.dim])  # other segments add nothing
        tier = np.frexp(np.abs(qf[self.dim[used]]))[1] + self.impact[used]
        done = 0
        for t in np.unique(tier)[::-1]:
            now = used[tier == t]
            size = self.end[now] - self.begin[now]
            at = np.arange(size.sum()) + np.repeat(self.begin[now] - (np.cumsum(size) - size), size)
            vec, value, part = self.vec[at], self.value[at], np.repeat(qf[self.dim[now]], size)
            acc += np.bincount(vec, value * part, n)
            rest_v -= np.bincount(vec, value**2, n)
            rest_q -= np.bincount(vec, part**2, n)
            done += len(now)
            reach = np.sqrt(np.maximum(rest_v, 0) * np.maximum(rest_q, 0)) + slack
            low = np.where(own, -np.inf, acc - reach)
            bound = max(least, np.partition(low, n - k)[n - k]) if n > k else least
            alive = ~own & (acc + reach >= bound)
            if alive.sum() <= max(FEW * k, n // SHARE):
                break
        self.processed, self.skipped = self.processed + done, self.skipped + len(used) - done
        found = np.flatnonzero(alive)
        return self.ids[found], exact(np.broadcast_to(q, (len(found), len(q))), self.v[found])


def vectors(df: DataFrame, scale: float = 1024.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, q: integer vectors of the rows whose id and components are all there and finite."""
    x = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    fine = F.forall("x", lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.select("vec_id", F.transform("x", lambda e: F.floor(e * F.lit(scale)).cast("long")).alias("q"))


def _of_block(vecs: DataFrame, part: list, k: int) -> DataFrame:
    """query (its place in part), query_id, vec_id, score: at least the k best of every task's vectors for each query of part (rows of vec_id, q)."""
    by_size: dict[int, list[int]] = {}
    for place, r in enumerate(part):
        by_size.setdefault(len(r["q"]), []).append(place)
    sent = vecs.sparkSession.sparkContext.broadcast({d: [(p, part[p]["vec_id"], np.array(part[p]["q"], np.int64)) for p in places] for d, places in by_size.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            ids, lists = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
            offset = lists.offsets.to_numpy()
            flat, size, offset = lists.values.to_numpy(zero_copy_only=False), np.diff(offset), offset[:-1]
            for d in np.unique(size).tolist():
                rows = np.flatnonzero(size == d) if d in sent.value else ()
                for a in range(0, len(rows), BLOCK):
                    some = rows[a : a + BLOCK]
                    index = Index(ids[some], flat[offset[some][:, None] + np.arange(d)[None, :]])
                    for place, q_id, q in sent.value[d]:
                        j, s = held.get(place, (np.empty(0, np.int64),) * 2)
                        new = index.search(q_id, q, k, float(s[k - 1]) if len(s) >= k else -np.inf)
                        j, s = np.concatenate([j, new[0]]), np.concatenate([s, new[1]])
                        keep = np.lexsort((j, -s))[:k]
                        held[place] = j[keep], s[keep]
        of = {place: q_id for some in sent.value.values() for place, q_id, _ in some}
        for place, (j, s) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), place, np.int32)), pa.array(np.full(len(j), of[place], np.int64)), pa.array(j), pa.array(s)], ["query", "query_id", "vec_id", "score"])

    return vecs.select("vec_id", "q").mapInArrow(run, "query int, query_id long, vec_id long, score long")


def search(vecs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors of highest inner product for each query, itself excluded.

    Both frames have vec_id and q (arrays of long). Vectors meet queries of the same number of
    components only. Ties go to the smaller id; repeated rows of an id are vectors of their own, but
    none answers a query of that id. Queries of one id with different vectors have a list each; queries repeated
    whole are one. Queries go to the workers in blocks of about ``QUERIES``, one block at a time: the driver holds
    no more of them, and what a block finds, k rows a query and task, is written before the next.
    """
    schema = "query_id long, rank int, vec_id long, score long"
    queries = materialize(queries.distinct().withColumn("block", F.xxhash64("vec_id", "q")))
    blocks, out = -(-queries.count() // QUERIES), None
    for n in range(blocks):
        part = queries.where(F.pmod("block", F.lit(blocks)) == n).sort("vec_id", "q").collect()  # about QUERIES rows
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
        one = _of_block(vecs, part, k).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        one = one if blocks == 1 else written(one, "topk")
        out = one if out is None else out.unionByName(one)
    return vecs.sparkSession.createDataFrame([], schema) if out is None else out


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = vectors(table(spark, sf_dir, "embeddings"))
    return search(vecs, vecs.where(F.col("vec_id") % 100 == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, a.q AS q, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v) a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id, q ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
