"""Line dedup by an exact set-similarity join, with DataFrame operations only (operator 7).

Equal lines fall together first; what follows works on distinct lines, each known by its first place. A
line's tokens are its distinct shingles of five words (of fewer words: the whole line). They are ordered by
rarity, from a count of all lines' shingles by a bounded number of hash buckets, then by hash. Only prefixes are written. Sets with a Jaccard similarity of ``t`` share a token in the first |x| - ceil(t|x|) + 1 of the larger
and the first |y| - ceil(2t/(1+t) |y|) + 1 of the smaller, so only those prefixes are joined, under the
length filter |y| >= t|x| and the positional filter (tokens seen plus those left must reach the overlap that
t asks for); the pairs that stay are verified on the whole sets, made again from the texts. A line goes if an earlier line, by (doc_id,
line number), is that similar: judged on the input, so the result doesn't depend on an order of removal.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.llm.common import likely, materialize, table, written

SHINGLE, SIMILAR = 5, 0.8
#: Hash buckets whose counts order tokens by rarity (the top bits of a hash), and levels to a doubling of the count.
BUCKET_BITS, STEPS = 14, 24
#: Of these bits so many tell apart the counts that one group of the count holds.
SIDE_BITS = 3
#: A token that may hold more than so many times the mean bucket is dealt to several tasks.
HOT = 4
#: Of a token's holders the earliest so many are held against all before them at once.
FEW = 32
#: Bits of a line's number in its place.
LINE_BITS = 31


def blanks(text: Column) -> Column:
    """A text whose only spaces inside lines are blanks; its lines stay."""
    text = F.coalesce(text, F.lit(""))
    odd = text.contains("\t") | text.contains("\r") | text.contains("\x0b") | text.contains("\x0c")
    return F.when(odd, F.translate(text, "\t\r\x0b\x0c", "    ")).otherwise(text)


def row_key(text_col: str) -> Column:
    """Tells apart texts under one id: the upper 32 bits of a text's hash, with its sign."""
    return F.shiftright(F.xxhash64(F.coalesce(text_col, F.lit(""))), 32)


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, at, line: the lines that have words, in lower case, and their places: of the row, then of the line in it."""
    rows = docs.select(F.col(id_col).alias("doc"), row_key(text_col).alias("rk"), F.lower(blanks(F.col(text_col))).alias("low"))
    rows = rows.select("doc", "rk", F.posexplode(F.split("low", "\n")).alias("line_no", "line")).where(F.trim("line") != "")
    return rows.select("doc", F.shiftleft("rk", LINE_BITS).bitwiseOR(F.col("line_no").cast("long")).alias("at"), "line")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """What use makes of a value that is worked out once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _words(line: str) -> Column:
    """The hashes of a line's words."""
    return F.transform(F.array_remove(F.split(line, " "), ""), lambda w: F.xxhash64(w))


def _shingle(h: Column, first: Column, i: Column) -> Column:
    """The hash of the shingle at place i of the words' hashes h, of which first is there; past the end there is null, which leaves a hash as it is."""
    return F.xxhash64(first, *[F.get(h, i + k) for k in range(1, SHINGLE)])


def with_tokens(rows: DataFrame) -> DataFrame:
    """Adds toks to rows with a column line: the set of shingle hashes of its words, each made of its words' hashes in one step.

    Functions of elements run outside generated code; what can do without them has a step of its own, in it.
    """
    starts = lambda h: F.slice(h, 1, F.greatest(F.size(h) - (SHINGLE - 1), F.lit(1)))
    shingles = _let(_words("line"), lambda h: F.transform(starts(h), lambda x, i: _shingle(h, x, i)))
    every = rows.select("*", shingles.alias("__every"))
    return every.select(*rows.columns, F.when(F.size("__every") > 1, F.array_distinct("__every")).otherwise(F.col("__every")).alias("toks"))


def rarity(rows: DataFrame) -> list[int]:
    """For each bucket a level, 0 to 1023, that rises with the count of its shingles in all lines of rows.

    A row for each shingle stays in generated code, which a line's set doesn't; repeats are counted. A group of the
    count holds ``1 << SIDE_BITS`` buckets side by side: so few groups stay in a core's cache, which a group a bucket doesn't.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size("h") - SHINGLE, F.lit(0)))
    each = rows.select(_words("line").alias("h")).select("h", F.explode_outer(starts).alias("i"))
    bucket = F.shiftrightunsigned(_shingle(F.col("h"), F.get("h", F.col("i")), F.col("i")), 64 - BUCKET_BITS).cast("int")
    side = range(1 << SIDE_BITS)
    of = [F.count(F.when(F.col("b").bitwiseAND(len(side) - 1) == k, 1)).alias(f"n{k}") for k in side]
    groups = each.select(bucket.alias("b")).groupBy(F.shiftright("b", SIDE_BITS).alias("g")).agg(*of).collect()  # 2**BUCKET_BITS counts at most
    count = {(r["g"] << SIDE_BITS) + k: r[f"n{k}"] for r in groups for k in side}
    return [min(1023, round(STEPS * math.log2(count.get(b, 0) + 1))) for b in range(1 << BUCKET_BITS)]


def ordered(hashes: Column, levels: list[int]) -> Column:
    """Tokens as numbers, to be sorted, whose ascending order is that of rarity: a level of ten bits over 53 bits of hash.

    There is a level for every bucket, but only a value that can't be null lets the array be sorted as plain numbers.
    """
    of = F.split(F.lit(",".join(str(x << 53) for x in levels)), ",").cast("array<long>")
    level = lambda h: F.coalesce(F.get(of, F.shiftrightunsigned(h, 64 - BUCKET_BITS)), F.lit(0).cast("long"))
    return F.transform(hashes, lambda h: level(h).bitwiseOR(F.shiftrightunsigned(h, 11)))


def parts_of(tok: Column, levels: list[int]) -> Column:
    """Into how many parts a token's holders are dealt, by its level: one for all but hot buckets."""
    mean = sum(2 ** (x / STEPS) for x in levels) / len(levels)
    parts = [str(min(1 << 20, math.ceil(2 ** (x / STEPS) / (HOT * mean)))) for x in range(1024)]
    return F.get(F.split(F.lit(",".join(parts)), ",").cast("array<int>"), F.shiftrightunsigned(tok, 53).cast("int"))


def least(share: float, n: Column) -> Column:
    """The smallest whole number that is at least share * n, safe from rounding."""
    return F.ceil(n * share - 1e-9).cast("int")


def _close(a: str, b: str, t: float) -> Column:
    """Whether two postings of one token (structs with n and i) pass the length, prefix and positional filters."""
    an, bn, ai, bi = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.i"), F.col(f"{b}.i")
    large, small = F.greatest(an, bn), F.least(an, bn)
    # the smaller set's shorter prefix is enough; of equal sizes either set may be the one that has it there
    at = F.when(an < bn, ai).when(bn < an, bi).otherwise(F.least(ai, bi))
    left = F.least(an - ai - 1, bn - bi - 1)
    return (small >= least(t, large)) & (at <= small - least(2 * t / (1 + t), small)) & (1 + left >= least(t / (1 + t), an + bn))


def _pairs(postings: DataFrame, t: float) -> DataFrame:
    """x, y: pairs from postings (x and y: structs of id, n, i) whose shared prefix tokens leave room for enough common ones."""
    p = postings.groupBy(F.col("x.id").alias("x"), F.col("y.id").alias("y")).agg(F.count("*").alias("seen"), F.first(F.col("x.n")).alias("xn"), F.first(F.col("y.n")).alias("yn"), F.max("x.i").alias("xi"), F.max("y.i").alias("yi"))
    return p.where(F.col("seen") + F.least(F.col("xn") - F.col("xi"), F.col("yn") - F.col("yi")) - 1 >= least(t / (1 + t), F.col("xn") + F.col("yn"))).select("x", "y")


def _similar(pairs: DataFrame, docs: DataFrame, t: float, id_col: str, text_col: str) -> DataFrame:
    """x of the pairs whose whole token sets, made from the texts that hold them, are similar, each once."""
    pairs = materialize(pairs)
    ids = pairs.select(F.explode(F.array("x", "y")).alias("id"))
    texts = likely(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), ids.select("id.doc"), ["doc"])
    near = likely(lines(texts, "doc").select(F.struct("doc", "at").alias("id"), "line"), ids, ["id"])
    # rows repeated whole have the same places
    near = with_tokens(near.groupBy("id").agg(F.first("line").alias("line")))
    both = pairs.join(near.select(F.col("id").alias("x"), F.col("toks").alias("u")), "x").join(near.select(F.col("id").alias("y"), F.col("toks").alias("v")), "y")
    enough = F.size(F.array_intersect("u", "v")) >= least(t / (1 + t), F.size("u") + F.size("v"))
    return both.where(enough).select("x").distinct()


def kept(docs: DataFrame, t: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, at (see ``lines``): the lines with words that stay, each once; all others that have words go.

    A set that comes after the ``FEW`` earliest holders of a prefix token is first held against the earliest
    of all, which settles most sets of a large group of near copies without its pairs; only what that leaves
    open is joined with all earlier holders. The holders of a token that is common even in prefixes are dealt to parts, each with an
    earliest holder of its own.

    Lines without words match nothing. Null texts are empty, a null id comes before all others, and of
    rows that share an id the one with the smaller hash of its text comes first; rows repeated whole
    count as one document, so they lose the same lines. An empty table gives no rows.
    """
    firsts = lines(docs, id_col, text_col).groupBy("line").agg(F.min(F.struct("doc", "at")).alias("own"))
    levels = rarity(lines(docs, id_col, text_col))

    heads = with_tokens(firsts).select("own.*", F.size("toks").alias("n"), ordered(F.col("toks"), levels).alias("keys"))
    n = F.size("keys")
    heads = written(heads.select("doc", "at", "n", F.slice(F.sort_array("keys"), 1, n - least(t, n) + 1).alias("prefix")), "lines")
    parts = parts_of(F.col("tok"), levels)
    salt = F.when(parts > 1, F.pmod(F.xxhash64("doc", "at"), parts)).otherwise(0).cast("int")
    # rows of few columns take the least room in the shuffle
    postings = heads.select("doc", "at", "n", F.posexplode("prefix").alias("i", "tok")).select(salt.alias("salt"), "doc", "tok", "at", F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("i").cast("long")).alias("ni"))
    upto = Window.partitionBy("tok", "salt").orderBy("doc", "at").rowsBetween(Window.unboundedPreceding, 0)
    led = postings.select("*", F.row_number().over(upto).alias("rank"), *[F.first(c).over(upto).alias(f"y_{c}") for c in ("doc", "at", "ni")])
    first = F.col("doc").eqNullSafe(F.col("y_doc")) & (F.col("at") == F.col("y_at"))
    # the earliest holder of a token's only part has nothing before it, and comes back as what others are held against
    led = led.where(~first | (parts > 1)).select("tok", "salt", parts.alias("parts"), ((F.col("rank") > FEW) | (parts > 1)).alias("late"), _posting(""), _posting("y_"))
    led = written(led, "shared")

    own = F.col("x.id") == F.col("y.id")
    sure = materialize(_similar(_pairs(led.where("late").where(~own & _close("x", "y", t)), t), docs, t, id_col, text_col))
    open_ = led.join(sure.select(F.col("x").alias("__x")), F.col("x.id") == F.col("__x"), "left_anti")
    open_ = open_.select("tok", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), "x")
    every = led.where(~own).select("tok", "salt", F.col("x").alias("y")).unionByName(led.select("tok", "salt", "y").distinct())
    rest = open_.join(every, ["tok", "salt"]).where((F.col("y.id") < F.col("x.id")) & _close("x", "y", t))
    gone = sure.unionByName(_similar(_pairs(rest, t), docs, t, id_col, text_col)).select("x.*").distinct()
    gone = gone.select(F.col("doc").alias("__doc"), F.col("at").alias("__at"))
    return heads.select("doc", "at").join(gone, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("at") == F.col("__at")), "left_anti")


def _posting(prefix: str) -> Column:
    doc, at, ni = (F.col(prefix + k) for k in ("doc", "at", "ni"))
    n, i = F.shiftright(ni, 32).cast("int"), ni.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    return F.struct(F.struct(doc.alias("doc"), at.alias("at")).alias("id"), n.alias("n"), i.alias("i")).alias("y" if prefix else "x")


def _kept(docs: DataFrame, t: float, id_col: str, text_col: str) -> DataFrame:
    """__id, __rk, __kept: the numbers of the lines that stay, for each text that keeps any."""
    number = F.col("at").bitwiseAND(F.lit((1 << LINE_BITS) - 1)).cast("int")
    return kept(docs, t, id_col, text_col).groupBy(F.col("doc").alias("__id"), F.shiftright("at", LINE_BITS).alias("__rk")).agg(F.collect_list(number).alias("__kept"))


def _spoken(every: Column) -> Column:
    """The numbers of the lines that have words, of the lines of a text whose spaces are blanks."""
    return F.array_compact(F.transform(every, lambda x, i: F.when(F.trim(x) != "", i)))


def summary(docs: DataFrame, t: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers from 0, comma-joined): a row for every row."""
    found = _kept(docs, t, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(text_col).alias("rk"), F.split(blanks(F.col(text_col)), "\n").alias("every"))
    rows = rows.select("doc_id", "rk", F.size("every").cast("long").alias("n_lines"), _spoken(F.col("every")).alias("spoken"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("rk") == F.col("__rk")), "left")
    gone = F.array_except("spoken", F.coalesce("__kept", F.array().cast("array<int>")))
    out = out.select("doc_id", "n_lines", gone.alias("gone"))
    return out.select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), F.array_join(F.col("gone").cast("array<string>"), ",").alias("removed"))


def remove_lines(docs: DataFrame, t: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, without the lines that match earlier ones.

    A document that loses all its lines with words goes; one that had none stays. Null texts stay null.
    Columns of docs may have any names but those that begin with two underscores.
    """
    found = _kept(docs, t, id_col, text_col)
    same = F.col(f"__doc.`{id_col}`").eqNullSafe(F.col("__id")) & (F.col("__mine") == F.col("__rk"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), row_key(text_col).alias("__mine"))
    out = rows.join(found, same, "left")
    text = F.col(f"__doc.`{text_col}`")
    out = out.withColumn("__gone", F.array_except(_spoken(F.split(blanks(text), "\n")), F.coalesce("__kept", F.array().cast("array<int>"))))
    every = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("__gone"))
    out = out.withColumn("__left", F.when(F.size("__gone") > 0, F.array_join(F.transform(left, lambda i: F.get(every, i)), "\n")).otherwise(text))
    out = out.where((F.size("__gone") == 0) | text.isNull() | F.col("__kept").isNotNull())
    return out.select(*[(F.col("__left") if c == text_col else F.col(f"__doc.`{c}`")).alias(c) for c in docs.columns])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(table(spark, sf_dir, "documents"))
