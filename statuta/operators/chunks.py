"""One text into many chunks: paragraphs, greedy packing, hard wraps, and windows of an embedder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.text import strip

#: Characters of a section, and how far beyond them a paragraph stays whole.
TARGET, WHOLE = 2000, 1.5
# An embedder's window.
CHARS_PER_TOKEN, WINDOW, SAFETY, MOST_CHUNKS = 1.5, 32_000, 0.75, 16_000
#: A clause's beginning: a number or a letter with a full stop or a bracket.
CLAUSE = r"(?U)^\s*(?:\d{1,3}|[Α-Ωα-ωA-Za-z])[.)]\s"
_NONE = "array<string>"


def is_table_line(line: Column) -> Column:
    s = strip(line)
    return (F.char_length(s) >= 3) & s.startswith("|") & s.endswith("|")


def paragraphs(text: Column) -> Column:
    """Blocks of lines: a blank line, a change between table and text, or a new clause begins one."""
    empty = F.array().cast(_NONE)
    begin = F.struct(empty.alias("lines"), F.lit(False).alias("table"), empty.alias("done"))

    def close(s: Column) -> Column:
        block = strip(F.array_join(s["lines"], "\n"))
        return F.when(block != "", F.concat(s["done"], F.array(block))).otherwise(s["done"])

    def step(s: Column, line: Column) -> Column:
        blank, table = strip(line) == "", is_table_line(line)
        cut = (F.size(s["lines"]) > 0) & ((table != s["table"]) | (~table & line.rlike(CLAUSE)))
        return (
            F.when(blank, F.struct(empty.alias("lines"), F.lit(False).alias("table"), close(s).alias("done")))
            .when(cut, F.struct(F.array(line).alias("lines"), table.alias("table"), close(s).alias("done")))
            .otherwise(F.struct(F.concat(s["lines"], F.array(line)).alias("lines"), table.alias("table"), s["done"].alias("done")))
        )

    return F.aggregate(F.split(text, "\n"), begin, step, close)


def hard_wrap(text: Column, n: int) -> Column:
    turns = F.sequence(F.lit(0), F.greatest(F.ceil(F.char_length(text) / n).cast("int") - 1, F.lit(0)))
    return F.transform(turns, lambda i: F.substring(text, i * n + 1, F.lit(n)))


def pack(blocks: Column, target: int = TARGET) -> Column:
    """Blocks packed in order into sections of about ``target`` characters; a longer block stands alone, wrapped only when far longer."""
    empty = F.array().cast(_NONE)
    begin = F.struct(empty.alias("cur"), F.lit(0).alias("size"), empty.alias("done"))

    def close(s: Column) -> Column:
        joined = strip(F.array_join(s["cur"], "\n\n"))
        return F.when(joined != "", F.concat(s["done"], F.array(joined))).otherwise(s["done"])

    def step(s: Column, p: Column) -> Column:
        n = F.char_length(p)
        alone = F.when(n > int(target * WHOLE), hard_wrap(p, target)).otherwise(F.array(p))
        fits = (s["size"] == 0) | (s["size"] + n + 2 <= target)
        return (
            F.when(n > target, F.struct(empty.alias("cur"), F.lit(0).alias("size"), F.concat(close(s), alone).alias("done")))
            .when(fits, F.struct(F.concat(s["cur"], F.array(p)).alias("cur"), (s["size"] + n + 2).alias("size"), s["done"].alias("done")))
            .otherwise(F.struct(F.array(p).alias("cur"), (n + 2).alias("size"), close(s).alias("done")))
        )

    return F.aggregate(blocks, begin, step, close)


def sections(text: Column, target: int = TARGET) -> Column:
    """A text in sections at paragraph boundaries; a short one stays whole."""

    def of(body: Column) -> Column:
        long = F.transform(F.array(pack(paragraphs(body), target)), lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(body)))
        return F.when(F.char_length(body) <= target, F.array(body)).otherwise(F.get(long, F.lit(0)))

    # the stripped text and its packed sections are bound, so that each is made once
    return F.get(F.transform(F.array(strip(text)), of), F.lit(0))


def estimated_tokens(n_chars: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n_chars / CHARS_PER_TOKEN).cast("int"))


def windows(sizes: Column, budget: int = int(WINDOW * SAFETY), most: int = MOST_CHUNKS) -> Column:
    """For sizes in order, the number (from 0) of the window each falls in: filled greedily up to the budget and the count."""
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("w"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        new = (s["n"] > 0) & ((s["sum"] + x > budget) | (s["n"] >= most))
        w = s["w"] + new.cast("int")
        return F.struct(F.when(new, 1).otherwise(s["n"] + 1).alias("n"), F.when(new, x.cast("long")).otherwise(s["sum"] + x).alias("sum"), w.alias("w"), F.concat(s["out"], F.array(w)).alias("out"))

    return F.aggregate(sizes, begin, step, lambda s: s["out"])


def plan_windows(chunks: DataFrame, group: str, order: str, n_chars: str, budget: int = int(WINDOW * SAFETY)) -> DataFrame:
    """group, order, window: each group's chunks in windows of the embedder. A group is one instrument's chunks."""
    lists = chunks.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), estimated_tokens(F.coalesce(n_chars, F.lit(0))).alias("t")))).alias("c"))
    out = lists.select(group, F.explode(F.arrays_zip(F.transform("c", lambda x: x["o"]).alias("o"), windows(F.transform("c", lambda x: x["t"]), budget).alias("w"))).alias("x"))
    return out.select(group, F.col("x.o").alias(order), F.col("x.w").alias("window"))


def split_oversized(text: Column, budget: int) -> Column:
    """Segments of at most ``budget`` estimated tokens, at paragraphs or sentences; longer pieces are cut."""
    most = int(budget * CHARS_PER_TOKEN)
    pieces = F.filter(F.split(text, r"(?U)(?<=\n\n)(?!\n)|(?<=[.;·])(?=\s)"), lambda p: strip(p) != "")
    cut = F.flatten(F.transform(pieces, lambda p: F.when(F.char_length(p) > most, hard_wrap(p, most)).otherwise(F.array(p))))
    begin = F.struct(F.lit("").alias("cur"), F.array().cast(_NONE).alias("done"))
    close = lambda s: F.when(s["cur"] != "", F.concat(s["done"], F.array(s["cur"]))).otherwise(s["done"])
    step = lambda s, p: F.when((s["cur"] != "") & (F.char_length(s["cur"]) + F.char_length(p) > most), F.struct(p.alias("cur"), close(s).alias("done"))).otherwise(F.struct(F.concat(s["cur"], p).alias("cur"), s["done"].alias("done")))
    return F.when(F.char_length(text) <= most, F.array(text)).otherwise(F.aggregate(cut, begin, step, close))
