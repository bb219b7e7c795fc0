"""Text normalisation as column expressions: glyph repair, folding, furniture, language, stemming."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Glyph variants and their canonical forms.
GLYPHS = {"∆": "Δ", "’": "'", "‘": "'", "΄": "'", "´": "'"}
# Latin capitals and small letters with a Greek look-alike.
CAPITALS = {"A": "Α", "B": "Β", "E": "Ε", "H": "Η", "I": "Ι", "K": "Κ", "M": "Μ", "N": "Ν", "O": "Ο", "P": "Ρ", "T": "Τ", "X": "Χ", "Y": "Υ", "Z": "Ζ"}
SMALL = {"a": "α", "e": "ε", "o": "ο", "v": "ν", "i": "ι", "k": "κ", "n": "η", "p": "ρ", "t": "τ", "x": "χ", "y": "υ"}
# Punctuation that may hang on a doubled word.
TAIL, LEAD = ",·;:)]}»”’", "([{«“‘"
GREEK, LATIN = "[\\u0370-\\u03FF\\u1F00-\\u1FFF]", "[A-Za-z]"
# Inflectional endings in folded letters.
ENDINGS = (
    "ματων", "ματοσ", "ματα", "ησεων", "ησεωσ", "ησεισ", "ξεων", "ξεωσ", "ξεισ", "ουνται", "ονται", "ομαι", "ειται", "εται", "ηκαν", "θηκε", "ουμε",
    "ουν", "ετε", "εισ", "ησε", "ασε", "ηση", "ξη", "εων", "εωσ", "ουσ", "οισ", "ων", "εσ", "οι", "ασ", "ησ", "οσ", "ου", "ο", "α", "η", "ε", "ω",
    "υ", "ι",
)
#: Letters that a stem keeps.
STEM = 3
# Gazette furniture, in the order of removal: (pattern, replacement).
FURNITURE = [
    (r"(?i)<!--\s*Page(?:Number|Header|Footer|Break)[^>]*-->", ""),
    (r"(?s)(?:ΚΑΠΟΔΙΣΤΡΙΟΥ\s+34|ΕΞΥΠΗΡΕΤΗΣΗ\s+ΚΟΙΝΟΥ|ΑΠΟ\s+ΤΟ\s+ΕΘΝΙΚΟ\s+ΤΥΠΟΓΡΑΦΕΙΟ).*\z", ""),
    (r"(?isu)\s*(?:ΕΦΗΜΕΡΙ[ΔΑ∆]+Α?\s+Τ?ΗΣ\s+ΚΥΒΕΡΝΗΣΕΩΣ\s*\d*\s*)?(?:Παραγγ[εέ]λλο(?:υ)?με|Θεωρήθηκε\s+και\s+τέθηκε\s+η\s+Μεγάλη\s+Σφραγίδα).*\z", ""),
    (r"(?imu)^\s*\d{0,5}\s*ΕΦΗΜΕΡΙ[ΔΑ∆]+Α?\s+Τ?ΗΣ\s+ΚΥΒΕΡΝΗΣΕΩΣ.*$", ""),
    (r"(?U)\bΤεύχος\s+[ΑΒΓΔΕAB]['’΄ʼ]?\s*\d+/\d{1,2}\.\d{1,2}\.\d{4}", " "),
    (r"(?m)^\s*\d{0,5}\s*(?:ΕΦΗΜΕΡΙ[ΔΑ∆]+Α?|ΚΥΒΕΡΝΗΣΕΩΣ)\s*\d{0,5}\s*$", ""),
    (r"(?m)^[ \t]*E[ \t]*\d{0,6}[ \t]*$", ""),
    (r"(?m)^\s*\*\d{6,}\*\s*$", ""),
    (r"[ \t]+", " "),
    (r"\n[ \t]*\n(?:[ \t]*\n)+", "\n\n"),
]
#: Every character that counts as a space, for trimming both ends.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


@lru_cache(maxsize=1)
def _accents() -> tuple[str, str]:
    """Letters with marks and their bare letters, by decomposition, for the Latin and Greek blocks."""
    pairs = []
    for c in map(chr, [*range(0x00C0, 0x0250), *range(0x0370, 0x0400), *range(0x1E00, 0x2000)]):
        bare = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(bare) == 1 and bare != c:
            pairs.append((c, bare))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def _swap(text: Column, table: dict[str, str]) -> Column:
    return F.translate(text, "".join(table), "".join(table.values()))


def fix_glyphs(text: Column) -> Column:
    return _swap(text, GLYPHS)


def dehyphenate(text: Column) -> Column:
    """Join words and law numbers that a line end splits."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)(\w)-\n(\w)", "$1$2"), r"(?U)(\d)/\n(\d)", "$1/$2")


def _tokens(text: Column, change) -> Column:
    """Apply a change to each run of non-spaces, keeping the spaces between."""
    parts = F.split(text, r"(?U)(?<=\s)(?=\S)|(?<=\S)(?=\s)")
    return F.array_join(F.transform(parts, change), "")


def undouble(text: Column) -> Column:
    """Undo glyphs drawn twice: words of at least three equal pairs, without digits, keep every second character."""
    core = r"(?:([^\d\s])\%d){3,}"

    def change(t: Column) -> Column:
        tail, lead = f"[{TAIL}]*".replace("]}", "\\]}"), f"[{LEAD}]*".replace("([{", "(\\[{")
        whole = t.rlike("(?U)^" + core % 1 + "$")
        inner = F.regexp_extract(t, f"(?U)^({lead})(.*?)({tail})$", 2)
        before, after = F.regexp_extract(t, f"(?U)^({lead})(.*?)({tail})$", 1), F.regexp_extract(t, f"(?U)^({lead})(.*?)({tail})$", 3)
        half = lambda x: F.regexp_replace(x, r"(?s)(.)\1", "$1")
        return F.when(whole, half(t)).when(inner.rlike("(?U)^" + core % 1 + "$"), F.concat(before, half(inner), after)).otherwise(t)

    return F.when(text.rlike(r"(?U)([^\d\s])\1([^\d\s])\2([^\d\s])\3"), _tokens(text, change)).otherwise(text)


@F.pandas_udf(StringType())
def _compose(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFC")


def compose(text: Column, exact: bool = False) -> Column:
    """Canonical composition. There is no built-in for it, so ``exact`` costs an Arrow round trip; else the input counts as composed."""
    return _compose(text) if exact else text


def display(text: Column, exact: bool = False) -> Column:
    """Text for storage: glyphs, doubled words, hyphenation and blanks repaired; accents and case kept."""
    out = dehyphenate(undouble(fix_glyphs(compose(text, exact))))
    return strip(F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def repair_capitals(heading: Column) -> Column:
    """Latin look-alikes become Greek in headings that are all capitals."""
    capital = (F.upper(heading) == heading) & heading.rlike(r"\p{Lu}")
    return F.when(capital, _swap(heading, CAPITALS)).otherwise(heading)


def fold(text: Column) -> Column:
    """Lower-case without accents, final sigma as sigma: the form of the keyword index."""
    return F.regexp_replace(F.translate(F.replace(F.lower(text), F.lit("ς"), F.lit("σ")), *_accents()), r"\p{Mn}+", "")


def mixed_script(text: Column) -> Column:
    """Repair glyphs, drop unmapped character codes, and turn Latin look-alikes Greek in words of both scripts."""
    clean = F.regexp_replace(F.translate(text, "∆∇", "Δν"), r"\(cid:\d+\)", " ")
    change = lambda t: F.when(t.rlike(GREEK) & t.rlike(LATIN), _swap(t, CAPITALS | SMALL)).otherwise(t)
    return F.when(clean.rlike(GREEK) & clean.rlike(LATIN), _tokens(clean, change)).otherwise(clean)


def strip_furniture(text: Column) -> Column:
    for pattern, by in FURNITURE:
        text = F.regexp_replace(text, pattern, by)
    return strip(text)


def count_of(text: Column, characters: str) -> Column:
    """How many of a class of characters a text has: what removing their runs takes away, so no match becomes a string."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, characters + "+", ""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def cid_ratio(text: Column) -> Column:
    """Share of words that are unmapped character codes."""
    w = words(F.coalesce(text, F.lit("")))
    return F.when(F.size(w) > 0, F.size(F.filter(w, lambda x: x.startswith("(cid:"))) / F.size(w)).otherwise(0.0)


def language(text: Column) -> Column:
    """el, en or mixed, by the share of Latin among Greek and Latin letters; el without letters."""
    t = F.coalesce(text, F.lit(""))
    greek, latin = count_of(t, GREEK), count_of(t, LATIN)
    share = latin / F.nullif(greek + latin, F.lit(0))
    return F.when(share.isNull() | (share < 0.15), "el").when(share > 0.85, "en").otherwise("mixed")


def stem_word(word: Column) -> Column:
    """Strip the longest ending that leaves three letters, again and again until none fits."""
    longest_first = "|".join(sorted(ENDINGS, key=len, reverse=True))
    # a lazy stem leaves the longest ending; a word loses a letter a turn at least, so turns follow its length
    turns = F.sequence(F.lit(1), F.greatest(F.char_length(word) - STEM, F.lit(1)))
    return F.aggregate(turns, word, lambda w, _: F.regexp_replace(w, f"^(.{{{STEM},}}?)(?:{longest_first})$", "$1"))


def stem(text: Column) -> Column:
    """Fold, then stem each Greek word; everything else stays as folded."""
    parts = F.split(fold(text), "(?<=[α-ωϊϋ])(?=[^α-ωϊϋ])|(?<=[^α-ωϊϋ])(?=[α-ωϊϋ])")
    done = F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[α-ωϊϋ]"), stem_word(p)).otherwise(p)), "")
    return F.when(text.isNull() | (text == ""), text).otherwise(done)


def first_line(text: Column) -> Column:
    """The first line that is not blank, stripped; empty without one."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    return F.coalesce(F.get(lines, F.lit(0)), F.lit(""))


def unquote(text: Column) -> Column:
    """Without one balanced outer pair of quotes."""
    t = strip(text)
    out = t
    for a, b in ("«»", "“”", "\"\"", "''"):
        out = F.when(t.startswith(a) & t.endswith(b) & (F.char_length(t) >= 2), strip(F.substring(t, F.lit(2), F.char_length(t) - 2))).otherwise(out)
    return out


def mask(secret: Column) -> Column:
    """First and last four characters and the length."""
    n = F.char_length(secret)
    return F.when(secret.isNull() | (n == 0), "(unset)").when(n <= 8, F.concat(F.lit("set(len="), n.cast("string"), F.lit(")"))).otherwise(F.concat(F.left(secret, F.lit(4)), F.lit("…"), F.right(secret, F.lit(4)), F.lit(" (len="), n.cast("string"), F.lit(")")))
