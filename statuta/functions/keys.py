"""Identity keys: how instruments, decisions, provisions and versions are named, and what names tell."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Instrument types, how their ids begin for display, and in keys.
DISPLAY = {
    "NOMOS": "ν.", "PD": "π.δ.", "PNP": "Π.Ν.Π.", "YA": "ΥΑ ", "KYA": "ΚΥΑ ", "PSIFISMA": "ψήφισμα ", "AN": "α.ν.", "ND": "ν.δ.",
    "KAN_VOULIS": "Καν.Βουλής ", "KAN_APOFASI": "καν.απόφ. ", "APOFASI_DIOIKITI": "απόφ.Διοικ. ", "APOFASI_PERIF": "απόφ.Περιφ. ",
    "APOFASI_NPDD": "απόφ.ΝΠΔΔ ", "ANAKOINOSI": "Ανακ. ", "PYS": "Π.Υ.Σ. ",
}
KEY = {
    "NOMOS": "N", "PD": "PD", "PNP": "PNP", "YA": "YA", "KYA": "KYA", "PSIFISMA": "PS", "AN": "AN", "ND": "ND", "KAN_VOULIS": "KANV",
    "KAN_APOFASI": "KANAP", "APOFASI_DIOIKITI": "APD", "APOFASI_PERIF": "APP", "APOFASI_NPDD": "APN", "ANAKOINOSI": "ANAK", "PYS": "PYS",
}
#: Where the part of an id that names a place in an instrument begins (a decision's own item is no such part).
PLACE = "#(?:αρ\\.|παραρτ|τμ\\.|full)"


def _lookup(kind: Column, table: dict[str, str], other: str) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(kind == k, v)
    return out.otherwise(other)


def instrument_id(kind: Column, number: Column, year: Column) -> Column:
    return F.concat(_lookup(kind, DISPLAY, "ν."), number.cast("string"), F.lit("/"), year.cast("string"))


def instrument_key(kind: Column, number: Column, year: Column) -> Column:
    return F.concat(_lookup(kind, KEY, "N"), number.cast("string"), F.lit("/"), year.cast("string"))


def _item(base: Column, item: Column | None) -> Column:
    return base if item is None else F.when(F.coalesce(item, F.lit(0)) != 0, F.concat(base, F.lit("#"), item.cast("string"))).otherwise(base)


def decision_id(series: Column, sheet: Column, year: Column, item: Column | None = None) -> Column:
    """By the gazette's coordinates, with the item where an issue holds several acts."""
    return _item(F.concat(series, F.lit("΄"), sheet, F.lit("/"), year.cast("string")), item)


def decision_key(series: Column, sheet: Column, year: Column, item: Column | None = None) -> Column:
    return _item(F.concat(series, sheet, F.lit("/"), year.cast("string")), item)


def dated_id(kind: Column, series: Column, sheet: Column, year: Column) -> Column:
    """For primary acts without a number: type and gazette coordinates."""
    return F.trim(F.concat(F.trim(_lookup(kind, DISPLAY, "")), F.lit(" "), series, F.lit("΄"), sheet, F.lit("/"), year.cast("string")))


def dated_key(kind: Column, series: Column, sheet: Column, year: Column) -> Column:
    return F.concat(_lookup(kind, KEY, ""), series, sheet, F.lit("/"), year.cast("string"))


def provision_id(instrument: Column, article: Column, paragraph: Column | None = None, case: Column | None = None) -> Column:
    part = lambda name, c: F.lit("") if c is None else F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(name), c)).otherwise("")
    return F.concat(instrument, F.lit("#αρ."), article, part(".παρ.", paragraph), part(".περ.", case))


def version_key(canonical: Column, valid_from: Column) -> Column:
    return F.concat(canonical, F.lit("@"), F.coalesce(F.nullif(valid_from.cast("string"), F.lit("")), F.lit("enacted")))


def uuid5(key: Column, namespace: uuid.UUID = uuid.NAMESPACE_DNS) -> Column:
    """Name-based UUID, version 5, as ``uuid.uuid5`` gives it."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(key, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def law_number(instrument: Column) -> Column:
    """What follows the last full stop."""
    return F.trim(F.substring_index(F.coalesce(instrument, F.lit("")), ".", -1))


def law_of(canonical: Column) -> Column:
    """The instrument's id: what stands before the place."""
    return F.split(canonical, PLACE, 2)[0]


def article_number(canonical: Column) -> Column:
    return F.regexp_extract(F.coalesce(canonical, F.lit("")), r"#αρ\.(\d+[Α-Ωα-ω]*)", 1)


def article_level(canonical: Column) -> Column:
    """The id of the article that a paragraph or a case belongs to."""
    return F.regexp_replace(canonical, r"\.(?:παρ|περ)\..*$", "")


def citation(query: Column) -> Column:
    """struct<article, paragraph, number, year, instrument_type, instrument_key, instrument_id>, null unless article and instrument are named."""
    article = F.regexp_extract(query, r"(?iU)(?:άρθρ(?:ο|ου)|αρθρ(?:ο|ου)|αρ\.?|article|art\.?)\s*(\d+[α-ωΑ-Ω]?)", 1)
    paragraph = F.regexp_extract(query, r"(?iU)(?:παρ(?:άγραφος|αγράφου)?\.?|paragraph|para\.?)\s*(\d+[α-ωΑ-Ω]?)", 1)
    instrument = r"(?iU)(ν\.?|νόμ(?:ος|ου|ο)|law|act|π\.?\s*δ\.?|προεδρικ\w*|presidential\s+decree)?\s*(\d{1,5})\s*/\s*(\d{4})"
    kind, number, year = (F.regexp_extract(query, instrument, k) for k in (1, 2, 3))
    kind = F.when(F.lower(kind).startswith("π") | F.lower(kind).contains("decree"), "PD").otherwise("NOMOS")
    number, year = number.cast("int"), year.cast("int")
    found = F.struct(article.alias("article"), F.nullif(paragraph, F.lit("")).alias("paragraph"), number.alias("number"), year.alias("year"), kind.alias("instrument_type"), instrument_key(kind, number, year).alias("instrument_key"), instrument_id(kind, number, year).alias("instrument_id"))
    return F.when((article != "") & query.rlike(instrument), found)


def rfc3339(date: Column) -> Column:
    """Midnight of a date in UTC, null for anything but YYYY-MM-DD."""
    return F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(date, F.lit("T00:00:00Z")))


# Months in the genitive, folded, in order.
MONTHS = "ιανουαριου φεβρουαριου μαρτιου απριλιου μαιου ιουνιου ιουλιου αυγουστου σεπτεμβριου οκτωβριου νοεμβριου δεκεμβριου".split()


def greek_date(text: Column) -> Column:
    """The first day, month and year whose month is one of the twelve, as YYYY-MM-DD; else null."""
    from statuta.functions.text import fold

    pattern = r"(\d{1,2})\s+([Α-Ωα-ωΆ-ώ]+)\s+(\d{4})"
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    months = F.array(*map(F.lit, MONTHS))
    # \s+ and the groups again on each hit
    read = F.transform(hits, lambda h: F.struct(F.regexp_extract(h, pattern, 3).alias("y"), F.array_position(months, fold(F.regexp_extract(h, pattern, 2))).alias("m"), F.regexp_extract(h, pattern, 1).alias("d")))
    first = F.get(F.filter(read, lambda r: r["m"] > 0), F.lit(0))
    return F.when(first.isNotNull(), F.concat_ws("-", first["y"], F.lpad(first["m"].cast("string"), 2, "0"), F.lpad(first["d"], 2, "0")))
