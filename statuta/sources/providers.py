"""Outside services behind one interface, with deterministic stand-ins: recognition, embeddings, language models, reranking.

A provider is a function of a list of inputs; it runs inside ``mapInPandas``, is rate-limited by task,
and retried. Results are kept by content, so a rerun asks only for what is new.
"""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.text import stem

# What in an error's text tells that another try may help, and that none will.
TRANSIENT = r"(?i)timeout|timed out|temporar|rate.?limit|429|too many requests|overloaded|connection reset|503|502|504"
FATAL = r"(?i)api.?key|unauthori[sz]ed|forbidden|401|403|quota|billing|insufficient|credit"


class Exhausted(RuntimeError):
    """A provider that kept failing for a passing reason."""


class Bucket:
    """Tokens that refill at a rate up to a burst; taking one waits for it."""

    def __init__(self, rate: float, burst: float | None = None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.rate, self.burst = rate, burst if burst is not None else 2 * rate
        self.clock, self.sleep = clock, sleep
        self.tokens, self.at = self.burst, clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            self.tokens, self.at = 1, self.clock()
        self.tokens -= 1


def retried(f: Callable, tries: int = 5, base: float = 2.0, sleep: Callable[[float], None] = time.sleep):
    """f's result; passing errors are tried again after a time that doubles, with jitter; others are raised at once."""
    for n in range(tries):
        try:
            return f()
        except Exception as e:
            if not re.search(TRANSIENT, str(e)):
                raise
            if n == tries - 1:
                raise Exhausted(str(e)) from e
            sleep(base**n + random.random())


def is_fatal(error: Column) -> Column:
    """Whether an error's text stops a whole run: none for passing ones."""
    return ~error.rlike(TRANSIENT) & error.rlike(FATAL)


def ask(df: DataFrame, key: str, content: str, provider: Callable[[list[str]], list], result: str, kind: str, rate: float | None = None, cache: DataFrame | None = None, tasks: int = 8, size: int = 64) -> DataFrame:
    """key, result for each row, by a provider; what the cache (content_hash, result) holds isn't asked for, and equal contents are asked for once.

    rate: calls a second over all tasks, of which each takes its share.
    """
    d = df.select(key, content, F.sha2(F.coalesce(content, F.lit("")), 256).alias("content_hash"))
    todo = d.groupBy("content_hash").agg(F.min(content).alias(content))
    if cache is not None:
        todo = todo.join(cache.select("content_hash"), "content_hash", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket = Bucket(rate / tasks) if rate else None
        for b in batches:
            for i in range(0, len(b), size):
                part = b.iloc[i : i + size]
                if bucket:
                    bucket.take()
                yield pd.DataFrame({"content_hash": part["content_hash"], result: retried(lambda part=part: provider([x or "" for x in part[content]]))})

    # every task has its share of the rate, so there may be no more of them
    made = (todo.repartition(tasks, "content_hash") if rate else todo).mapInPandas(run, f"content_hash string, {result} {kind}")
    if cache is not None:
        made = made.unionByName(cache.select("content_hash", result))
    return d.join(made, "content_hash").select(key, "content_hash", result)


def hashed_embedding(text: Column, size: int = 1024) -> Column:
    """A stand-in for an embedding model: signed counts of stems by hash, of unit norm. Zero without words."""
    stems = F.filter(F.split(stem(F.coalesce(text, F.lit(""))), r"(?U)\W+"), lambda w: w != "")
    slots = F.transform(stems, lambda w: F.struct(F.pmod(F.xxhash64(w), F.lit(size)).cast("int").alias("i"), F.when(F.pmod(F.hash(w), F.lit(2)) == 0, 1.0).otherwise(-1.0).alias("s")))
    zero = F.array_repeat(F.lit(0.0), size)
    # counts by slot as a map, then spread over the vector
    sums = F.aggregate(slots, F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<double>")), lambda m, x: F.map_concat(F.map_filter(m, lambda k, v: k != x["i"]), F.create_map(x["i"], F.coalesce(F.element_at(m, x["i"]), F.lit(0.0)) + x["s"])))
    norm = F.sqrt(F.aggregate(F.map_values(sums), F.lit(0.0), lambda a, v: a + v * v))
    return F.transform(zero, lambda z, i: (F.coalesce(F.element_at(sums, i), z) / F.when(norm == 0, 1.0).otherwise(norm)).cast("float"))


def lenient_json(text: Column, schema: str) -> Column:
    """JSON in a model's answer: the whole of it, or what stands between the outermost braces."""
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.from_json(F.when(inner != "", inner).otherwise(text), schema)


def nothing(text: Column) -> Column:
    """Empty for the words by which models say nothing."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(F.lower(t).isin("null", "none", "n/a", "-", "—", "nil"), "").otherwise(t)


# Actions and scopes that a model may name.
ACTIONS = ["replaces", "adds", "repeals", "renumbers", "consolidates", "modifies", "amends", "suspends"]
SCOPES = ["document", "article", "paragraph", "case", "subcase", "phrase"]


def action(text: Column) -> Column:
    t = F.lower(nothing(text))
    return F.when(t.isin(*ACTIONS), t).otherwise("amends")


def scope(text: Column) -> Column:
    t = F.lower(nothing(text))
    return F.when(t.isin(*SCOPES), t).otherwise("article")


def law_summary(title: Column, category: Column, n_articles: Column) -> Column:
    """What stands for a law's summary without a model."""
    return F.left(F.concat_ws(", ", F.concat_ws(" — ", F.nullif(title, F.lit("")), F.nullif(category, F.lit(""))), F.when(n_articles > 0, F.concat(n_articles.cast("string"), F.lit(" άρθρα")))), F.lit(1200))
