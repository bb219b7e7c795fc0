"""Amendment edges: verbs, references, hygiene, and consolidation inside an instrument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions import keys
from statuta.functions.text import strip
from statuta.operators.store import beside

# Actions whose edges carry text.
CONTENTFUL = ["replaces", "adds", "modifies", "amends", "consolidates"]
# Actions that say nothing without a text, quotation marks, and headings that aren't a body.
TEXTUAL = ["adds", "replaces", "consolidates", "modifies"]
QUOTES = "«»“”„‹›‘’'\""
STRUCTURE = r"(?U)^\s*(?:ΚΕΦΑΛΑΙΟ|Κεφάλαιο|ΤΜΗΜΑ|Τμήμα|ΜΕΡΟΣ|Μέρος)\b"
#: Characters of a text that makes an edge without a place worth keeping.
FRAGMENT = 25


def unquoted(text: Column) -> Column:
    return strip(F.trim(strip(F.coalesce(text, F.lit(""))), F.lit(QUOTES)))


def heading_only(text: Column) -> Column:
    """Whether a text is empty, a short line without small letters, or a short structural heading."""
    t = strip(F.coalesce(text, F.lit("")))
    n = F.char_length(t)
    return (t == "") | (~t.rlike(r"\p{Ll}") & (n <= 80)) | (t.rlike(STRUCTURE) & (n <= 40))


def drop_contradicted_repeals(edges: DataFrame, source: str = "source_id", target: str = "target_id") -> DataFrame:
    """Without empty repeals whose source gives their target a text."""
    restated = edges.where(F.col("action").isin(*CONTENTFUL) & (strip(F.coalesce("text", F.lit(""))) != "")).select(F.col(source).alias("__s"), F.col(target).alias("__t")).distinct()
    empty = (F.col("action") == "repeals") & (strip(F.coalesce("text", F.lit(""))) == "")
    e = edges.join(restated.withColumn("__hit", F.lit(True)), (F.col(source) == F.col("__s")) & (F.col(target) == F.col("__t")), "left")
    return e.where(~(empty & F.coalesce("__hit", F.lit(False)))).select(*edges.columns)


def dedupe(edges: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first edge of each key, and of the first 120 characters of its text: a minimum a key, combined before the shuffle."""
    head = F.left(F.coalesce("text", F.lit("")), F.lit(120))
    rest = [c for c in edges.columns if c not in (*by, *order)]
    first = edges.select(*by, head.alias("__head"), F.struct(*order, *rest).alias("__x")).groupBy(*by, "__head").agg(F.min("__x").alias("__x"))
    return first.select(*by, "__x.*").select(*edges.columns)


def collapse_restatements(edges: DataFrame, target: str, order: str, shortest: int = 6) -> DataFrame:
    """Within a target: without empty contentful edges where a sibling has text, and without texts that stand inside a longer sibling's.

    The containment join runs inside a target, over its distinct texts only, and between texts of different length, longest kept.
    """
    contentful = F.col("action").isin(*CONTENTFUL)
    t = edges.withColumn("__t", unquoted(F.col("text")))
    has = t.where(contentful & (F.col("__t") != "")).select(F.col(target).alias("__h")).distinct().withColumn("__has", F.lit(True))
    t = t.join(has, t[target] == F.col("__h"), "left").where(~(contentful & (F.col("__t") == "") & F.coalesce("__has", F.lit(False)))).drop("__h", "__has")
    texts = t.where(F.char_length("__t") >= shortest).select(F.col(target).alias("__k"), F.col("__t").alias("__s")).distinct()
    longer = texts.where(F.char_length("__s") > shortest).select(F.col("__k").alias("__l"), F.col("__s").alias("__long"))
    inside = (F.col("__k") == F.col("__l")) & (F.char_length("__s") < F.char_length("__long")) & F.col("__long").contains(F.col("__s"))
    within = texts.join(longer, inside, "left_semi")
    return t.join(within, (t[target] == F.col("__k")) & (F.col("__t") == F.col("__s")), "left_anti").select(*edges.columns)


def clean(edges: DataFrame, own: str | None = None, order: str = "ordinal") -> DataFrame:
    """The rules in their order: edges that say nothing go, repeats go, restatements fall together, contradicted repeals go."""
    text = strip(F.coalesce("text", F.lit("")))
    textual = F.col("action").isin(*TEXTUAL)
    placed = F.coalesce("target_id", F.lit("")).contains("#αρ.")
    keep = ~(textual & (text == "") & ~placed) & ~(textual & (text != "") & heading_only(F.col("text"))) & (placed | F.col("resolved") | (F.char_length(text) >= FRAGMENT))
    if own is not None:
        own = F.col(own) if own in edges.columns else F.lit(own)
        keep = keep & (placed | ~((F.col("target_id") == own) | F.col("target_id").startswith(F.concat(own, F.lit("#")))))
    e = dedupe(edges.where(keep), ["action", "target_id"], [order])
    return drop_contradicted_repeals(collapse_restatements(e, "target_id", order))


def consolidate(provisions: DataFrame, edges: DataFrame) -> DataFrame:
    """Provisions (canonical_id, text) with the replacing edges (target_id, source_id, action, text, resolved, ordinal) of their own instrument applied in order.

    Gives canonical_id, text_in_force, text_as_enacted (null without an edit), version, amended_by.
    """
    e = edges.where(F.col("action").isin("replaces", "consolidates") & F.col("resolved") & (F.coalesce("text", F.lit("")) != ""))
    e = e.groupBy(F.col("target_id").alias("canonical_id")).agg(F.max_by("text", "ordinal").alias("last"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("ordinal", "source_id"))).alias("by"))
    out = provisions.join(e, "canonical_id", "left")
    hit = F.col("last").isNotNull()
    return out.select("canonical_id", F.coalesce("last", "text").alias("text_in_force"), F.when(hit, F.col("text")).alias("text_as_enacted"), (F.coalesce("n", F.lit(0)) + 1).cast("int").alias("version"), F.coalesce(F.array_distinct(F.transform("by", lambda x: x["source_id"])), F.array().cast("array<string>")).alias("amended_by"))


# Acts of the European Union with the body before or behind their number, and their names.
EU_BEFORE = r"(?iuU)(Κανονισμ\w*|Οδηγί\w*|Απόφασ\w*)\s*\(?\s*(ΕΕ|ΕΚ|ΕΟΚ)\s*\)?\s*(?:αριθ\.?\s*)?(\d{1,4}/\d{2,4})"
EU_BEHIND = r"(?iuU)(Κανονισμ\w*|Οδηγί\w*|Απόφασ\w*)\s*(\d{4}/\d{1,4})\s*/\s*(ΕΕ|ΕΚ|ΕΟΚ)"
EU_NAMES = {"κ": "Κανονισμός", "ο": "Οδηγία", "α": "Απόφαση"}


def eu_references(text: Column) -> Column:
    """Acts of the European Union that a text names, those with the body first before the others, each once, as ``ΕΕ:Κανονισμός 2022/868``."""

    def read(pattern: str, body: int, number: int) -> Column:
        def name(h: Column) -> Column:
            first, out = F.lower(F.left(h, F.lit(1))), F
            for k, v in EU_NAMES.items():
                out = out.when(first == k, v)
            return F.concat(F.upper(F.regexp_extract(h, pattern, body)), F.lit(":"), out.otherwise(F.regexp_extract(h, pattern, 1)), F.lit(" "), F.regexp_extract(h, pattern, number))

        return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0)), name)

    return F.array_distinct(F.concat(read(EU_BEFORE, 2, 3), read(EU_BEHIND, 3, 2)))


def graph_status(edges: DataFrame, documents: DataFrame, sample: int = 50) -> DataFrame:
    """One row: total, present, missing, undated, unresolved, missing_laws (sorted, distinct, the first ``sample``).

    edges: target_law, effective_date, resolved. documents: law. Samples come from a distinct top list, so no set is gathered.
    """
    known = documents.select(F.col("law").alias("__law"), F.lit(True).alias("__known")).distinct()
    e = edges.join(known, edges["target_law"] == F.col("__law"), "left")
    named = F.coalesce("target_law", F.lit("")) != ""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    totals = e.agg(F.count("*").alias("total"), n(named & F.col("__known").isNotNull()).alias("present"), n(named & F.col("__known").isNull()).alias("missing"), n(F.col("effective_date").isNull()).alias("undated"), n(~F.col("resolved")).alias("unresolved"))
    names = e.where(named & F.col("__known").isNull()).select("target_law").distinct().orderBy("target_law").limit(sample)
    listed = names.agg(F.array_join(F.sort_array(F.collect_list("target_law")), ",").alias("missing_laws"))
    return beside(totals, listed)


def outside(points: DataFrame, spans: DataFrame, key: str, at: str) -> DataFrame:
    """Points that lie in no open span (a, b) of their key: an equi-join with a range, anti."""
    s = spans.withColumnsRenamed({key: "__key"})
    return points.join(s, (points[key] == s["__key"]) & (s["a"] < points[at]) & (points[at] < s["b"]), "left_anti")


def target_of(law: Column, article: Column, paragraph: Column | None = None) -> Column:
    return keys.provision_id(law, article, paragraph)
