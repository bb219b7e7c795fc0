"""The identity of an issue from its masthead, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta.functions import keys
from statuta.functions.text import strip

#: Characters of an issue that hold its masthead, and how near a bare number follows its header.
HEAD, NEAR, TITLE = 4000, 40, 600
# Header patterns of the instrument types, most specific first; {n} marks where a number follows.
_AFTER = r"\s+ΥΠ['΄ʼ’]?\s*ΑΡΙΘ(?:ΜΟΣ|ΜΟΝ|Μ|\.)?\.?\s*{n}"
TYPES = [
    ("PNP", r"ΠΡΑΞΗ\s+ΝΟΜΟΘΕΤΙΚΟΥ\s+ΠΕΡΙΕΧΟΜΕΝΟΥ"),
    ("PYS", r"ΠΡΑΞ(?:Η|ΕΙΣ)\s+ΥΠΟΥΡΓΙΚΟΥ\s+ΣΥΜΒΟΥΛΙΟΥ"),
    ("AN", r"ΑΝΑΓΚΑΣΤΙΚΟΣ\s+ΝΟΜΟΣ" + _AFTER),
    ("ND", r"ΝΟΜΟΘΕΤΙΚΟ\s+ΔΙΑΤΑΓΜΑ" + _AFTER),
    ("KAN_VOULIS", r"ΚΑΝΟΝΙΣΜΟΣ\s+(?:ΤΗΣ\s+)?ΒΟΥΛΗΣ"),
    ("PD", r"ΠΡΟΕΔΡΙΚΟ\s+ΔΙΑΤΑΓΜΑ" + _AFTER),
    ("KAN_APOFASI", r"ΚΑΝΟΝΙΣΤΙΚΗ\s+(?:ΠΡΑΞΗ|ΑΠΟΦΑΣΗ)"),
    ("APOFASI_PERIF", r"ΑΠΟΦΑΣΗ\s+ΠΕΡΙΦΕΡΕΙΑΡΧΗ|ΑΠΟΦΑΣΗ\s+(?:ΔΗΜΑΡΧΟΥ|ΔΗΜΟΤΙΚΟΥ\s+ΣΥΜΒΟΥΛΙΟΥ)"),
    ("APOFASI_NPDD", r"ΑΠΟΦΑΣΗ\s+(?:ΤΟΥ\s+)?Δ(?:ΙΟΙΚΗΤΙΚΟΥ)?\.?\s*Σ(?:ΥΜΒΟΥΛΙΟΥ)?\.?\s+(?:ΤΟΥ\s+)?ΝΠΔΔ"),
    ("APOFASI_DIOIKITI", r"ΑΠΟΦΑΣΗ\s+(?:ΔΙΟΙΚΗΤΗ|ΓΕΝΙΚΟΥ\s+ΓΡΑΜΜΑΤΕΑ|ΓΕΝ\.?\s*ΓΡΑΜΜΑΤΕΑ)"),
    ("KYA", r"ΚΟΙΝΗ\s+ΥΠΟΥΡΓΙΚΗ\s+ΑΠΟΦΑΣΗ"),
    ("YA", r"ΥΠΟΥΡΓΙΚΗ\s+ΑΠΟΦΑΣΗ"),
    ("PSIFISMA", r"ΨΗΦΙΣΜΑ"),
    ("NOMOS", r"ΝΟΜΟΣ" + _AFTER),
    ("PD", r"\bΠ\.?\s*Δ\.?\s*(?:ΑΡΙΘ(?:ΜΟΣ|ΜΟΝ|Μ|\.)?\.?)?\s*{n}"),
    ("ANAKOINOSI", r"(?m:^[ \t]*ΑΝΑΚΟΙΝΩΣ(?:ΕΙΣ|Η)\.?[ \t]*$)"),
]
# Types that carry no number.
NUMBERLESS = ["PNP", "YA", "KYA", "PSIFISMA", "KAN_VOULIS", "KAN_APOFASI", "APOFASI_DIOIKITI", "APOFASI_PERIF", "APOFASI_NPDD", "ANAKOINOSI", "PYS"]
# Words and letters of the gazette's series.
SERIES = {"ΠΡΩΤΟ": "Α", "ΔΕΥΤΕΡΟ": "Β", "ΤΡΙΤΟ": "Γ", "ΤΕΤΑΡΤΟ": "Δ", "ΠΕΜΠΤΟ": "Ε"}
LETTERS = {"Α": "Α", "A": "Α", "Β": "Β", "B": "Β", "Γ": "Γ", "Δ": "Δ", "Ε": "Ε", "E": "Ε"}
TITLE_ENDS = r"(?U)(?:[ΟΗ]\s+ΠΡΟΕΔΡΟΣ\s+ΤΗΣ\s+ΕΛΛΗΝΙΚΗΣ|Εκδίδ[οσ]\w*\s+τον\b|ΠΙΝΑΚΑΣ\s+ΠΕΡΙΕΧΟΜΕΝΩΝ|\bΆρθρο\s+\d|\bΑΡΘΡΟ\s+\d|\n\s*\n)"
_FLAGS = "(?iuU)"


def _map(value: Column, table: dict[str, str]) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(value == k, v)
    return out.otherwise("")


def masthead(text: Column) -> Column:
    """struct<instrument_type, number, year, title, fek_series, fek_number, fek_date, warnings>.

    The type is that of the header that stands first, ties to the more specific pattern.
    """
    t = F.coalesce(text, F.lit(""))
    head = F.left(t, F.lit(HEAD))

    def candidate(i: int, kind: str, pattern: str) -> Column:
        p = _FLAGS + pattern.replace("{n}", r"(?:\d{1,5})") if "{n}" in pattern else _FLAGS + pattern
        whole = F.regexp_extract(head, p, 0)
        number = F.regexp_extract(head, _FLAGS + pattern.replace("{n}", r"(\d{1,5})"), 1).cast("int") if "{n}" in pattern else F.lit(None).cast("int")
        at = F.regexp_instr(head, F.lit(p))
        return F.when(at > 0, F.struct(at.alias("at"), F.lit(i).alias("rank"), F.lit(kind).alias("kind"), number.alias("number"), (at - 1 + F.char_length(whole)).alias("end")))

    first = F.array_min(F.array_compact(F.array(*[candidate(i, k, p) for i, (k, p) in enumerate(TYPES)])))
    bare = r"(?mU)^\s*(\d{1,5})\s*$"

    def read(f: Column) -> Column:
        tail = F.substring(t, f["end"] + 1, F.char_length(t))
        near = f["number"].isNull() & (F.regexp_instr(F.left(tail, F.lit(HEAD)), F.lit(bare)) > 0) & (F.regexp_instr(F.left(tail, F.lit(HEAD)), F.lit(bare)) <= NEAR)
        number = F.when(near, F.regexp_extract(tail, bare, 1).cast("int")).otherwise(f["number"])
        skip = F.when(near, F.regexp_instr(tail, F.lit(bare)) - 1 + F.char_length(F.regexp_extract(tail, bare, 0))).otherwise(0)
        rest = F.substring(tail, skip + 1, F.char_length(tail))
        ended = F.split(rest, TITLE_ENDS, 2)
        block = F.when(F.size(ended) > 1, ended[0]).otherwise(F.left(rest, F.lit(TITLE)))
        date = keys.greek_date(head)
        word = F.upper(F.regexp_extract(head, _FLAGS + r"ΤΕΥΧΟΣ\s+(ΠΡΩΤΟ|ΔΕΥΤΕΡΟ|ΤΡΙΤΟ|ΤΕΤΑΡΤΟ|ΠΕΜΠΤΟ)", 1))
        letter = F.upper(F.regexp_extract(t, _FLAGS + r"Τε[υύ]χος\s+([ΑΒΓΔΕABEZH])\s*['΄ʼ’]", 1))
        series = F.when(word != "", _map(word, SERIES)).otherwise(_map(letter, LETTERS))
        sheet = F.regexp_extract(head, _FLAGS + r"Αρ(?:ιθμ(?:ός|\.)?|\.)\s*Φ[υύ]λλου\s*(\d{1,6})", 1)
        kind = f["kind"]
        warnings = F.array_compact(F.array(
            F.when(kind.isNull(), F.lit("instrument_type not found in masthead")),
            F.when(kind.isNotNull() & ~kind.isin(*NUMBERLESS) & number.isNull(), F.lit("instrument number not found")),
            F.when(date.isNull(), F.lit("fek_date/year not found")),
            F.when((word == "") & (series == ""), F.lit("fek_series (τεύχος) not found")),
            F.when(sheet == "", F.lit("fek_number (αρ. φύλλου) not found")),
        ))
        title = F.when(kind.isNull(), "").otherwise(strip(F.regexp_replace(block, r"(?U)\s+", " ")))
        return F.struct(kind.alias("instrument_type"), number.alias("number"), F.left(date, F.lit(4)).cast("int").alias("year"), title.alias("title"), series.alias("fek_series"), sheet.alias("fek_number"), date.alias("fek_date"), warnings.alias("warnings"))

    return F.get(F.transform(F.array(first), read), F.lit(0))


def best(*mastheads: Column) -> Column:
    """The masthead that resolves most of type, number, year, series and sheet; the first of equals."""
    def points(m: Column) -> Column:
        return sum((c.cast("int") for c in (m["instrument_type"].isNotNull(), m["number"].isNotNull(), m["year"].isNotNull(), m["fek_series"] != "", m["fek_number"] != "")), F.lit(0))

    ranked = F.array(*[F.struct((-points(m)).alias("p"), F.lit(i).alias("i"), m.alias("m")) for i, m in enumerate(mastheads)])
    least = F.array_min(F.transform(ranked, lambda r: F.struct(r["p"].alias("p"), r["i"].alias("i"))))
    return F.element_at(F.transform(ranked, lambda r: r["m"]), least["i"] + 1)
