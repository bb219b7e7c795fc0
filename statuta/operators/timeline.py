"""Versions of provisions over time: the ordered fold of edits, and what is in force when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions import keys
from statuta.functions.text import unquote
from statuta.operators.store import beside

HEAD = "struct<version:int,valid_from:date,valid_to:date,text:string,status:string>"


def _apply(previous: Column, action: Column, text: Column) -> Column:
    """A provision's text after an edit."""
    given = F.coalesce(text, F.lit("")) != ""
    return F.when(action == "repeals", previous).when((action == "adds") & given, F.concat_ws("\n", previous, text)).when(given, text).otherwise(previous)


def fold(base: DataFrame, edits: DataFrame, as_stored: bool = False) -> DataFrame:
    """aid, version, valid_from, valid_to, is_current, status, text: the windows of each provision's text.

    base: aid, valid_from, text (one row an aid). edits: aid, effective_date, ordinal, source, action,
    text; those of one aid are folded in the order of date, ordinal, source. An edit of the window's own
    date changes that window; any other closes it and opens the next; a repeal ends the fold.
    as_stored: a window's own-date edits show only in later windows, and a closed window takes the base's status.
    Edits of an aid without a base are left to ``pending``. An aid's edits are one list in one task.
    """
    step = F.struct("effective_date", F.coalesce("ordinal", F.lit(0)).alias("ordinal"), F.coalesce("source", F.lit("")).alias("source"), "action", "text")
    lists = edits.where(F.col("effective_date").isNotNull()).groupBy("aid").agg(F.array_sort(F.collect_list(step)).alias("edits"))
    rows = base.select("aid", F.col("valid_from").cast("date").alias("valid_from"), "text").join(lists, "aid", "left")
    first = F.struct(F.lit(1).alias("version"), F.col("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.col("text").cast("string").alias("text"), F.lit("in_force").alias("status"))
    state = F.struct(first.alias("head"), F.array().cast(f"array<{HEAD}>").alias("done"), F.lit(False).alias("ended"), F.col("text").cast("string").alias("text"))

    def turn(s: Column, e: Column) -> Column:
        head, text = s["head"], _apply(s["text"], e["action"], e["text"])
        repeal = e["action"] == "repeals"
        status = F.when(repeal, "repealed").otherwise("amended")
        shown, same_status, ends = (head["text"], head["status"], F.lit(False)) if as_stored else (text, status, repeal)
        same = F.struct(F.struct(head["version"].alias("version"), head["valid_from"].alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), shown.alias("text"), same_status.alias("status")).alias("head"), s["done"].alias("done"), ends.alias("ended"), text.alias("text"))
        closed_status = F.lit("in_force") if as_stored else head["status"]
        closed = F.struct(head["version"].alias("version"), head["valid_from"].alias("valid_from"), e["effective_date"].alias("valid_to"), head["text"].alias("text"), closed_status.alias("status"))
        opened = F.struct((head["version"] + 1).alias("version"), e["effective_date"].alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), text.alias("text"), status.alias("status"))
        new = F.struct(opened.alias("head"), F.concat(s["done"], F.array(closed)).alias("done"), repeal.alias("ended"), text.alias("text"))
        return F.when(s["ended"], s).when(e["effective_date"] == head["valid_from"], same).otherwise(new)

    folded = F.aggregate(F.coalesce("edits", F.array().cast(lists.schema["edits"].dataType)), state, turn, lambda s: F.concat(s["done"], F.array(s["head"])))
    out = rows.select("aid", F.explode(folded).alias("v")).select("aid", "v.*")
    return out.select("aid", "version", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), "status", "text")


def assemble(edges: DataFrame, articles: DataFrame, documents: DataFrame, as_stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """(versions, counters) from amendment edges and what is stored.

    edges: target_id, effective_date, ordinal, source_law, action, text. articles: aid, valid_from, text
    (the enacted rows). documents: law, publication_date. An edge whose law or article is absent stays
    pending and may resolve later; an article that an edit adds as a whole starts with that edit; edits
    below the article are counted as linked and don't rewrite it.
    counters: articles, versions_written, pending, linked_subedits.
    """
    e = edges.where((F.coalesce("target_id", F.lit("")) != "") & F.col("effective_date").isNotNull())
    e = e.withColumn("aid", keys.article_level(F.col("target_id"))).withColumn("law", keys.law_of(F.col("aid")))
    e = e.join(documents.select("law", F.lit(True).alias("known"), F.col("publication_date").cast("date").alias("published")).dropDuplicates(["law"]), "law", "left")
    stored = articles.select("aid", F.col("valid_from").cast("date").alias("published"), F.col("text").alias("base_text"), F.lit(True).alias("has_base"))
    e = e.join(stored, ["aid", "published"], "left").withColumn("whole", F.col("target_id") == F.col("aid"))
    seeds = (~F.coalesce("has_base", F.lit(False))) & F.coalesce("known", F.lit(False)) & F.col("whole") & (F.col("action") == "adds") & (F.coalesce("text", F.lit("")) != "")
    rank = F.row_number().over(Window.partitionBy("aid", seeds).orderBy("effective_date", F.coalesce("ordinal", F.lit(0)), "source_law"))
    e = e.withColumn("seed", seeds & (rank == 1))
    any_seed = F.max(F.col("seed").cast("int")).over(Window.partitionBy("aid")) == 1
    e = e.withColumn("live", F.coalesce("known", F.lit(False)) & (F.coalesce("has_base", F.lit(False)) | any_seed))
    live = e.where("live")
    bases = live.where("has_base").groupBy("aid").agg(F.first("published").alias("valid_from"), F.first("base_text").alias("text"), F.lit(0).alias("made"))
    made = live.where("seed").select("aid", F.col("effective_date").cast("date").alias("valid_from"), unquote(F.col("text")).alias("text"), F.lit(1).alias("made"))
    base = bases.unionByName(made)
    edits = live.where("whole and not seed").select("aid", F.col("effective_date").cast("date").alias("effective_date"), "ordinal", F.col("source_law").alias("source"), "action", unquote(F.col("text")).alias("text"))
    versions = fold(base, edits, as_stored)
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    told = e.agg(count(~F.col("live")).alias("pending"), count(F.col("live") & ~F.col("whole")).alias("linked_subedits"))
    written = beside(versions.where("version > 1").agg(F.count("*").alias("later")), base.agg(F.count("*").alias("articles"), count(F.col("made")).alias("made")))
    counters = beside(told, written).select("articles", (F.col("later") + F.col("made")).alias("versions_written"), "pending", "linked_subedits")
    return versions, counters


def current(versions: DataFrame) -> DataFrame:
    """What is in force now; a repealed last version isn't."""
    return versions.where("is_current and status <> 'repealed'")


def as_of(versions: DataFrame, date: str) -> DataFrame:
    """What was in force on a date: windows hold their first day and not their last."""
    d = F.lit(date).cast("date")
    return versions.where((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") > d)))


def as_of_join(points: DataFrame, versions: DataFrame, key: str, at: str) -> DataFrame:
    """Points with the version of their key at their time: an equi-join with a range, left outer."""
    p, v = points.alias("p"), versions.alias("v")
    inside = (F.col(f"p.{key}") == F.col("v.aid")) & (F.col("v.valid_from") <= F.col(f"p.{at}")) & (F.col("v.valid_to").isNull() | (F.col("v.valid_to") > F.col(f"p.{at}")))
    return p.join(v, inside, "left").select("p.*", "v.version", "v.status", "v.text")


def history(edits: DataFrame, versions: DataFrame, limit: int | None = 500, preview: int = 240) -> DataFrame:
    """kind, at, ref, action, preview: edits and versions of one provision in the order of time."""
    short = lambda c: F.when(F.char_length(c) > preview, F.concat(F.left(c, F.lit(preview)), F.lit("…"))).otherwise(c)
    a = edits.select(F.lit("edit").alias("kind"), F.col("effective_date").cast("date").alias("at"), F.col("source").cast("string").alias("ref"), "action", short(F.col("text")).alias("preview"))
    b = versions.select(F.lit("version").alias("kind"), F.col("valid_from").alias("at"), F.col("version").cast("string").alias("ref"), F.col("status").alias("action"), short(F.col("text")).alias("preview"))
    cut = lambda df: df if limit is None else df.orderBy("at", "ref").limit(limit)
    return cut(a).unionByName(cut(b))


def traverse(edges: DataFrame, start: DataFrame, hops: int, source: str = "src", target: str = "dst") -> DataFrame:
    """node, hop: what the start nodes reach within a number of hops, each at its least hop."""
    e = edges.select(F.col(source).alias("__s"), F.col(target).alias("__t")).distinct()
    seen = front = start.select("node").distinct().withColumn("hop", F.lit(0))
    for k in range(1, hops + 1):
        front = front.join(e, front["node"] == e["__s"]).select(F.col("__t").alias("node")).distinct()
        front = front.join(seen.select("node"), "node", "left_anti").withColumn("hop", F.lit(k))
        seen = seen.unionByName(front)
    return seen
