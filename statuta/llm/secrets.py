r"""Secret scans by patterns and a randomness test battery, with DataFrame operations only (operator 8).

Patterns give the base spans. What else looks like a credential is a run of at least ``SHORTEST``
characters of the base64 alphabets. Its encoding is inferred (hexadecimal, letters of one case, base32,
base64), and its symbols go through three tests of randomness: chi-squared uniformity over quarters of the
alphabet, Wald-Wolfowitz runs, and serial correlation at lag one. None may reject; and what they find is held
against the null that the run is an ordinary word, path, name or number of its encoding and length, which
gives the p-value. Benjamini-Hochberg, run for each
class of lengths over all candidates of the corpus, bounds the share of ordinary runs among those found.

Positions are code points. A pattern's matches and the pieces between them give the positions, as sums of
lengths. Texts are scanned once; only counts of p-values by bin, a bounded table, reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.llm.common import materialize, table

# Base patterns (kind, pattern, group to measure, least length), in the order of ties.
BASE = [
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
RANDOM = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
SHORTEST = 20
# Alphabets of the encodings.
ALPHABETS = {16: "0123456789abcdef", 26: "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 32: "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 64: "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
# Symbols from common to rare in ordinary runs (letters by their frequency), read in four equal classes,
# and the classes' shares there: of numbers in hexadecimal, of words elsewhere, with some capitals and digits in base64.
CLASSES_OF = {
    16: "0123456789abcdef",
    26: "ETAOINSRHLDCUMFPGWYBVKXJQZ",
    32: "ETAOINSRHLDCUMFPGWYBVKXJQZ234567",
    64: "+/etaoinsrhldcumfpgwybvkxjqzETAOINSRHLDCUMFPGWYBVKXJQZ0123456789",
}
SHARES = {16: (0.4, 0.4, 0.18, 0.02), 26: (0.58, 0.26, 0.11, 0.05), 32: (0.62, 0.26, 0.09, 0.03), 64: (0.74, 0.16, 0.06, 0.04)}
#: How much more ordinary runs differ among themselves than draws from one distribution.
SPREAD = 1.6
#: Share of false discoveries, and p-value below which a test of randomness rejects.
FALSE, REJECT = 0.01, 0.001
#: Rates in ordinary runs: of changes of kind, the same in runs of one letter case, and of turns between vowels and consonants.
CHANGES, CHANGES_ONE_CASE, TURNS = 0.25, 0.02, 0.58
#: Serial correlations in ordinary runs: of kinds, and of vowels.
SERIAL_KINDS, SERIAL_VOWELS = 0.3, -0.35
#: Matches of a text that are placed together.
BLOCK = 256
#: Bins of a decade of p-values, decades that are told apart, and starts of the length classes.
BINS, DECADES, CLASSES = 10, 30, (20, 28, 40, 64)


def spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, end, match>> of leftmost non-overlapping matches whose group has ``least`` characters.

    Matches are placed in blocks of ``BLOCK``, so the work grows with their number in a text, not its square.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), whole.alias("match"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    pieces = zipped.cast("array<struct<piece:string,match:string,value:string>>")
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["piece"])
        end = start + F.coalesce(F.char_length(x["match"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match")))
        return F.struct(end.alias("at"), F.when(F.char_length(x["value"]) >= least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def block(acc: Column, part: Column) -> Column:
        placed = F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return F.get(F.transform(F.array(placed), lambda r: F.struct(r["at"].alias("at"), F.concat(acc["outs"], F.array(r["out"])).alias("outs"))), 0)

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,match:string>>>").alias("outs"))
    blocks = lambda p: F.transform(F.sequence(F.lit(1), F.size(p), F.lit(BLOCK)), lambda i: F.slice(p, i, F.lit(BLOCK)))
    placed = F.get(F.transform(F.array(pieces), lambda p: F.flatten(F.aggregate(blocks(p), begin, block, lambda a: a["outs"]))), 0)
    return F.when(text.rlike(pattern), placed).otherwise(none)


def ordered(found: Column, kind: int) -> Column:
    """The spans as structs that sort by start, then kind."""
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("order"), s["end"].alias("end")))


def _count(x: Column, k: int) -> Column:
    return F.size(F.filter(x, lambda v: v == k))


def normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by the logistic form of Page's approximation."""
    return 1.0 / (1.0 + F.exp(F.lit(2 * math.sqrt(2 / math.pi)) * (z + 0.044715 * F.pow(z, 3))))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """Chernoff's bound on the probability of k or more changes in n places; it is never below the tail itself."""
    x = F.least(k / F.greatest(n, F.lit(1.0)), F.lit(1.0))
    part = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    return F.when(x > rate, F.exp(-n * (part(x, rate) + part(1 - x, 1 - rate)))).otherwise(1.0)


def chi_squared(classes: Column, shares: list[Column], n: Column) -> Column:
    """Chi-squared statistic of symbols' classes (0 to 3) against the shares that are expected of them."""
    return sum((F.pow(_count(classes, k) - n * q, 2) / (n * q) for k, q in enumerate(shares)), F.lit(0.0))


def chi_tail(x: Column) -> Column:
    """Upper tail of the chi-squared distribution with three degrees of freedom, by Wilson and Hilferty's approximation."""
    return normal_tail((F.cbrt(x / 3) - (1 - 2 / 27)) / math.sqrt(2 / 27))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda t, v: t + v)


def _neighbours(x: Column, f) -> Column:
    """Sum of f over neighbouring elements."""
    most = F.greatest(F.size(x) - 1, F.lit(0))
    return _total(F.zip_with(F.slice(x, 1, most), F.slice(x, 2, most), f))


def _serial(x: Column) -> Column:
    """Serial correlation at lag one, null for a constant sequence."""
    mid = _total(F.transform(x, lambda v: v.cast("double"))) / F.size(x)
    var = _total(F.transform(x, lambda v: F.pow(v - mid, 2)))
    return F.when(var > 0, _neighbours(x, lambda a, b: (a - mid) * (b - mid)) / var)


def test(match: Column) -> Column:
    """struct<p, random>: p-value under the null that a run is ordinary, and whether all randomness tests accept it.

    Each test of the battery is held against both nulls. Under randomness it may only reject (``REJECT``, for the
    three together). Under ordinary text of the run's encoding and length its statistic gives a p-value: of four
    classes of symbols the common ones prevail, which chi-squared measures; runs of letter kinds are few (and
    vowels alternate with consonants where there is one kind); kinds follow themselves. The three p-values
    combine by Fisher's sum, scaled for the dependence of the last two.
    """
    text = F.regexp_replace(F.translate(match, "-_", "+/"), "=+$", "")
    size = F.when(text.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 16).when(text.rlike("^(?:[A-Z]+|[a-z]+)$"), 26).when(text.rlike("^(?:[A-Z2-7]+|[a-z2-7]+)$"), 32).otherwise(64)

    def pick(size: Column, table: dict) -> Column:
        return F.when(size == 16, table[16]).when(size == 26, table[26]).when(size == 32, table[32]).otherwise(table[64])

    alphabet, classes = pick(size, {k: F.lit(v) for k, v in ALPHABETS.items()}), pick(size, {k: F.lit(v) for k, v in CLASSES_OF.items()})
    codes = F.filter(F.split(F.when(size == 64, text).when(size == 16, F.lower(text)).otherwise(F.upper(text)), ""), lambda c: c != "")
    kinds = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.when(c.rlike("[A-Z]"), 1).when(c.rlike("[0-9]"), 2).otherwise(0))  # what separates words changes nothing
    made = F.struct(
        size.alias("size"),
        F.transform(codes, lambda c: F.instr(alphabet, c) - 1).alias("x"),
        F.transform(codes, lambda c: F.floor((F.instr(classes, c) - 1) * 4 / size)).alias("class"),
        kinds.alias("kind"),
        F.transform(codes, lambda c: c.rlike("[AEIOUY]").cast("int")).alias("vowel"),
    )

    def judge(s: Column) -> Column:
        x, size, n = s["x"], s["size"], F.size(s["x"]).cast("double")
        # under randomness
        p_even = chi_tail(chi_squared(F.transform(x, lambda v: F.floor(v * 4 / size)), [F.lit(0.25)] * 4, n))
        high = F.size(F.filter(x, lambda v: v * 2 >= size)).cast("double")
        runs = 1 + _neighbours(x, lambda a, b: ((a * 2 >= size) != (b * 2 >= size)).cast("double"))
        mean = 1 + 2 * high * (n - high) / n
        z_runs = (runs - mean) / F.sqrt(F.greatest((mean - 1) * (mean - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.25)))
        z_serial = F.coalesce(_serial(x) * F.sqrt(n), F.lit(99.0))
        worst = F.least(p_even, 2 * normal_tail(F.abs(z_runs)), 2 * normal_tail(F.abs(z_serial)))
        # under ordinary text
        p_chi = chi_tail(chi_squared(s["class"], [pick(size, {k: F.lit(v[c]) for k, v in SHARES.items()}) for c in range(4)], n) / SPREAD)
        changes = _neighbours(s["kind"], lambda a, b: (a != b).cast("double"))
        turns = _neighbours(s["vowel"], lambda a, b: (a != b).cast("double"))
        z_kinds = (changes - 0.5 - CHANGES * (n - 1)) / F.sqrt(CHANGES * (1 - CHANGES) * F.greatest(n - 1, F.lit(1.0)))
        z_turns = (TURNS * (n - 1) - turns - 0.5) / F.sqrt(TURNS * (1 - TURNS) * F.greatest(n - 1, F.lit(1.0)))
        rare = binomial_tail(changes, n - 1, CHANGES_ONE_CASE)
        p_runs = F.when(size == 64, normal_tail(z_kinds)).when(size == 16, rare).when(size == 26, normal_tail(z_turns)).otherwise(F.least(F.lit(1.0), 2 * F.least(rare, normal_tail(z_turns))))
        one = (size == 26) | (size == 32)
        r = F.coalesce(_serial(F.when(one, s["vowel"]).otherwise(s["kind"])), F.when(one, -1.0).otherwise(1.0))
        p_serial = normal_tail(F.when(one, r - SERIAL_VOWELS).otherwise(SERIAL_KINDS - r) * F.sqrt(n))
        h = -(2 / 3) * sum((F.log(F.greatest(p, F.lit(1e-30))) for p in (p_chi, p_runs, p_serial)), F.lit(0.0))
        p = F.least(F.lit(1.0), F.exp(-h) * (1 + h))
        return F.struct(F.when(n >= SHORTEST - 2, p).otherwise(1.0).alias("p"), F.coalesce(worst * 3 >= REJECT, F.lit(False)).alias("random"))

    return F.get(F.transform(F.array(made), judge), 0)


def length_class(n: Column) -> Column:
    return sum(((n >= c).cast("int") for c in CLASSES[1:]), F.lit(0))


def bin_of(p: Column) -> Column:
    """Number of the bin of a p-value; a larger number is a smaller p-value."""
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS), F.lit(BINS * DECADES)).cast("int")


def thresholds(counts: list[tuple[int, int, int]]) -> dict[int, int]:
    """For each length class the first bin that Benjamini-Hochberg accepts, from (class, bin, count).

    A bin's p-values count as its upper edge, so the bound on false discoveries holds.
    """
    out = {}
    for c in {x[0] for x in counts}:
        of = sorted(((b, n) for k, b, n in counts if k == c), reverse=True)
        m, seen = sum(n for _, n in of), 0
        for b, n in of:
            seen += n
            if 10.0 ** (-b / BINS) <= FALSE * seen / m:
                out[c] = b
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans: a row for every row.

    Null texts are empty: no spans, and the hash of the empty string. Null ids are kept, repeated rows
    each give their row, an empty table gives no rows, and other columns are not read. A run that
    touches a base span is no candidate. Spans are kind:start:end, by start, then kind, comma-joined.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), *[spans(text, p, g, n).alias(k) for k, p, g, n in BASE], spans(text, RANDOM, 0, SHORTEST).alias("runs"))
    found = found.withColumn("base", F.concat(*[ordered(F.col(k), r) for r, (k, *_) in enumerate(BASE)]))
    free = F.filter("runs", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    tested = F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), test(s["match"]).alias("t")))
    binned = F.transform(tested, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), length_class(s["end"] - s["start"]).alias("class"), bin_of(s["t"]["p"]).alias("bin"), s["t"]["random"].alias("random")))
    found = materialize(found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k, *_ in BASE], "base", binned.alias("runs")))
    counts = found.select(F.explode("runs").alias("r")).groupBy("r.class", "r.bin").agg(F.count("*").alias("n")).collect()  # classes times bins
    least = thresholds([tuple(r) for r in counts])
    accept = F.filter("runs", lambda r: r["random"] & (r["bin"] >= F.element_at(F.array(*[F.lit(least.get(k, BINS * DECADES + 1)) for k in range(len(CLASSES))]), r["class"] + 1)))
    more = ordered(accept, len(BASE))
    names = F.array(*[F.lit(k) for k, *_ in BASE], F.lit("random"))

    def joined(a: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(a), lambda s: F.concat_ws(":", F.element_at(names, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select("doc_id", *[f"n_{k}" for k, *_ in BASE], F.size(more).cast("long").alias("n_random"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", more)).alias("spans"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
