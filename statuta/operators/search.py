"""Search: keyword ranking by BM25, exact nearest vectors, fusion of rankings, pooling, twin removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.operators.store import beside

B, K1 = 0.3, 1.5


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"(?U)\W+"), lambda w: w != "")


def whitespace(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda w: w != "")


def trigrams(text: Column) -> Column:
    t = F.lower(text)
    return F.when(F.char_length(t) >= 3, F.transform(F.sequence(F.lit(1), F.char_length(t) - 2), lambda i: F.substring(t, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))


def field(text: Column) -> Column:
    return F.array(F.trim(text))


TOKENIZERS = {"word": words, "lowercase": whitespace, "trigram": trigrams, "field": field}


def bm25(docs: DataFrame, terms: list[str], id_col: str, text_col: str, k: int | None = 20, b: float = B, k1: float = K1, tokenizer: str = "word", stop: frozenset[str] = frozenset(), digits: int = 6) -> DataFrame:
    """id, score of the documents that hold a term, best first, ties to the smaller id.

    Only the terms' counts leave the scan: each document becomes its length and an array of counts, so no
    word is exploded or shuffled. Corpus statistics are one global aggregate, joined as a single row.
    """
    terms = [t for t in dict.fromkeys(terms) if t not in stop]
    toks = TOKENIZERS[tokenizer](F.coalesce(text_col, F.lit("")))
    if stop:
        toks = F.filter(toks, lambda w: ~w.isin(*stop))
    d = docs.select(F.col(id_col).alias("id"), toks.alias("toks"))
    tf = [F.size(F.filter("toks", lambda w: w == F.lit(t))).alias(f"tf{i}") for i, t in enumerate(terms)]
    d = d.select("id", F.size("toks").alias("len"), *tf)
    stats = d.agg(F.count("*").alias("n"), F.avg("len").alias("avg"), *[F.sum((F.col(f"tf{i}") > 0).cast("long")).alias(f"df{i}") for i in range(len(terms))])
    d = beside(d.where(" or ".join(f"tf{i} > 0" for i in range(len(terms))) or "false"), stats)

    def part(i: int) -> Column:
        idf = F.log(1 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
        f = F.col(f"tf{i}")
        return idf * f * (k1 + 1) / (f + k1 * (1 - b + b * F.col("len") / F.col("avg")))

    score = sum((part(i) for i in range(len(terms))), F.lit(0.0))
    out = d.select(F.col("id").alias(id_col), F.round(score, digits).alias("score"))
    return out if k is None else out.orderBy(F.col("score").desc(), id_col).limit(k)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def nearest(vectors: DataFrame, query: list[float], id_col: str, vec_col: str, k: int = 10, digits: int = 6) -> DataFrame:
    """id, score: the k largest inner products with one query vector, exact; a top-k heap a task, then one merge."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.where(F.col(vec_col).isNotNull()).select(id_col, F.round(dot(F.col(vec_col), q), digits).alias("score")).orderBy(F.col("score").desc(), id_col).limit(k)


def pool(vectors: DataFrame, by: str, vec_col: str, digits: int = 6) -> DataFrame:
    """by, dim, value: each group's mean direction, renormalised. Sums by dimension are combined before the shuffle."""
    x = vectors.select(by, F.posexplode(vec_col).alias("dim", "v")).groupBy(by, "dim").agg(F.sum(F.col("v").cast("double")).alias("s"))
    norm = x.groupBy(by).agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("norm"))
    return x.join(norm, by).select(by, "dim", F.round(F.col("s") / F.when(F.col("norm") == 0, 1.0).otherwise(F.col("norm")), digits).alias("value"))


def fuse(rankings: list[DataFrame], id_col: str, k: int = 10, constant: int = 60, digits: int = 9) -> DataFrame:
    """id, score: reciprocal-rank fusion of rankings, each with id and score (their top lists, of bounded length)."""
    parts = []
    for r in rankings:
        rank = F.row_number().over(Window.orderBy(F.col("score").desc(), id_col))
        parts.append(r.select(id_col, (1.0 / (constant + rank)).alias("part")))
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.unionByName(p)
    return all_.groupBy(id_col).agg(F.round(F.sum("part"), digits).alias("score")).orderBy(F.col("score").desc(), id_col).limit(k)


def without_twins(docs: DataFrame, key: Column, prefer: Column, id_col: str) -> DataFrame:
    """The row of each key that is preferred (true first), then of the smallest id: one minimum a key, combined before the shuffle."""
    best = docs.select(key.alias("twin_key"), F.struct((~prefer).cast("int").alias("o"), F.col(id_col).alias("id")).alias("x")).groupBy("twin_key").agg(F.min("x").alias("x"), F.count("*").alias("n"))
    return best.select(F.col("x.id").alias(id_col), "twin_key", "n")
