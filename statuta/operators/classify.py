"""Classification against controlled vocabularies: precise patterns first, keywords where none matches."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.text import fold

# Patterns of cited codes and framework laws, and their domains, in the order of the labels.
CODES = [
    (r"Ποινικ\w+\s+Κώδικ", "criminal"),
    (r"Κώδικα?\s+Ποινικής\s+Δικονομίας|ΚΠΔ\b", "criminal_procedure"),
    (r"Αστικ\w+\s+Κώδικ", "civil"),
    (r"Κώδικα?\s+Πολιτικής\s+Δικονομίας|ΚΠολΔ\b", "civil_procedure"),
    (r"4808/2021|Εργατικ\w+|Κώδικα?\s+Εργασίας", "labor"),
    (r"Κώδικα?\s+Φορολογ\w*|\bΦΠΑ\b|4172/2013|4174/2013|ΚΦΕ\b|ΚΦΔ\b", "tax"),
    (r"4412/2016|4413/2016|δημόσι\w+\s+συμβάσε\w+", "public_procurement"),
    (r"4624/2019|2016/679|\bGDPR\b|προσωπικ\w+\s+δεδομέν\w+", "data_protection"),
    (r"4548/2018|4072/2012|ανώνυμ\w+\s+εταιρ\w+|\bΕΠΕ\b|\bΙΚΕ\b", "corporate"),
    (r"4738/2020|πτωχευτικ\w+|αφερεγγυότητ\w+", "insolvency"),
    (r"2960/2001|τελωνειακ\w+|δασμ\w+", "customs"),
    (r"1650/1986|4014/2011|4685/2020|περιβάλλον\w*|περιβαλλοντικ\w+", "environmental"),
    (r"4001/2011|4951/2022|ενεργειακ\w+|ΑΠΕ\b|ανανεώσιμ\w+\s+πηγ", "energy"),
    (r"2690/1999|Κώδικα?\s+Διοικητικής\s+Διαδικασίας|2717/1999|Κώδικα?\s+Διοικητικής\s+Δικονομίας|ΚΔΔ\b", "administrative"),
    (r"Εμπορικ\w+\s+Νόμ\w+|Εμπορικ\w+\s+Κώδικ|5325/1932|αξιόγραφ\w+|2251/1994|προστασ\w+\s+(?:του\s+)?καταναλωτ|αγορανομικ\w+|αθέμιτ\w+\s+ανταγωνισμ", "commercial"),
    (r"\bΣύνταγμα\b|Συντάγματος|συνταγματικ\w+", "constitutional"),
    (r"Οδηγί\w+\s+\(?(?:ΕΕ|Ε\.Ε\.|ΕΚ|ΕΟΚ)\)?|Κανονισμ\w+\s+\(?(?:ΕΕ|Ε\.Ε\.|ΕΚ)\)?|ενωσιακ\w+\s+δίκαι|δίκαι\w+\s+της\s+Ευρωπαϊκ\w+\s+Ένωσ", "eu_law"),
    (r"4387/2016|ασφαλιστικ\w+\s+(?:φορέ|νομοθεσ)|κοινωνικ\w+\s+ασφάλισ|συνταξιοδοτικ\w+", "social_security"),
    (r"4600/2019|4512/2018|υγειονομικ\w+|δημόσι\w+\s+υγεί|\bΕΣΥ\b", "health"),
    (r"4957/2022|4547/2018|τριτοβάθμι\w+\s+εκπαίδευσ|πανεπιστήμι\w+|σχολικ\w+\s+μονάδ", "education"),
    (r"\bΚΟΚ\b|Κώδικα?\s+Οδικής\s+Κυκλοφορίας|αεροπορικ\w+\s+μεταφορ|ναυτιλιακ\w+|σιδηροδρομικ\w+", "transport"),
    (r"4727/2020|ψηφιακ\w+\s+διακυβέρν|ηλεκτρονικ\w+\s+διακυβέρν|Κώδικα?\s+Ψηφιακής", "digital"),
    (r"3883/2010|ένοπλ\w+\s+δυνάμ|στρατιωτικ\w+\s+προσωπικ|εθνικ\w+\s+άμυν", "defense"),
    (r"4251/2014|3386/2005|μεταναστευτικ\w+|\bάσυλο\b|αιτ\w+\s+ασύλου", "immigration"),
]
# Folded keywords of each domain, in the order of the labels.
KEYWORDS = [
    ("criminal", ["ποινη", "εγκλημα", "κακουργημα"]),
    ("civil", ["διαζυγιο", "κληρονομια", "συμβαση"]),
    ("labor", ["μισθος", "εργαζομεν", "απολυση"]),
    ("tax", ["φορος", "φορολογ", "εισοδημα"]),
    ("public_procurement", ["διαγωνισμος", "αναθετουσα"]),
    ("data_protection", ["προσωπικα δεδομεν", "απορρητο"]),
    ("corporate", ["μετοχ", "εταιρ"]),
    ("commercial", ["καταναλωτ", "αγορανομ", "λιανεμπορ"]),
    ("environmental", ["περιβαλλον"]),
    ("energy", ["ενεργειακ"]),
    ("constitutional", ["συνταγμα", "συνταγματικ"]),
    ("social_security", ["ασφαλιστικ", "συνταξ"]),
    ("health", ["υγειονομ", "νοσοκομει"]),
    ("education", ["εκπαιδευ", "πανεπιστημ"]),
    ("immigration", ["μεταναστ"]),
    ("defense", ["στρατιωτικ"]),
    ("digital", ["ψηφιακ"]),
]
# A ministry or secretariat with the capitalised portfolio that follows.
PORTFOLIO = r"(?U)(?:Υπουργ\w*|Γενικ\w+\s+Γραμματ\w+|Γραμματ(?:έας|είας|έα))\s+(?:[Α-ΩΆ-Ώ][α-ωά-ώϊϋΐΰ]+\s*|και\s+|,\s*)+"


# Volumes of the subject index by domain.
VOLUMES = {
    "criminal": "ΠΟΙΝΙΚΗ ΝΟΜΟΘΕΣΙΑ", "criminal_procedure": "ΠΟΙΝΙΚΗ ΔΙΚΟΝΟΜΙΑ", "civil": "ΑΣΤΙΚΗ ΝΟΜΟΘΕΣΙΑ", "civil_procedure": "ΠΟΛΙΤΙΚΗ ΔΙΚΟΝΟΜΙΑ",
    "labor": "ΕΡΓΑΤΙΚΗ ΝΟΜΟΘΕΣΙΑ", "tax": "ΦΟΡΟΛΟΓΙΚΗ ΝΟΜΟΘΕΣΙΑ", "public_procurement": "ΔΗΜΟΣΙΕΣ ΣΥΜΒΑΣΕΙΣ", "data_protection": "ΠΡΟΣΤΑΣΙΑ ΠΡΟΣΩΠΙΚΩΝ ΔΕΔΟΜΕΝΩΝ",
    "corporate": "ΕΜΠΟΡΙΚΗ ΝΟΜΟΘΕΣΙΑ", "insolvency": "ΕΜΠΟΡΙΚΗ ΝΟΜΟΘΕΣΙΑ", "customs": "ΤΕΛΩΝΕΙΑΚΗ ΝΟΜΟΘΕΣΙΑ", "environmental": "ΠΕΡΙΒΑΛΛΟΝΤΙΚΗ ΝΟΜΟΘΕΣΙΑ",
    "energy": "ΕΝΕΡΓΕΙΑ", "administrative": "ΔΙΟΙΚΗΤΙΚΗ ΝΟΜΟΘΕΣΙΑ", "commercial": "ΕΜΠΟΡΙΚΗ ΝΟΜΟΘΕΣΙΑ", "constitutional": "ΣΥΝΤΑΓΜΑΤΙΚΗ ΝΟΜΟΘΕΣΙΑ",
    "eu_law": "ΔΙΕΘΝΕΙΣ ΣΧΕΣΕΙΣ", "social_security": "ΚΟΙΝΩΝΙΚΗ ΑΣΦΑΛΙΣΗ", "health": "ΥΓΕΙΟΝΟΜΙΚΗ ΝΟΜΟΘΕΣΙΑ", "education": "ΕΚΠΑΙΔΕΥΤΙΚΗ ΝΟΜΟΘΕΣΙΑ",
    "transport": "ΜΕΤΑΦΟΡΕΣ ΚΑΙ ΕΠΙΚΟΙΝΩΝΙΕΣ", "digital": "ΗΛΕΚΤΡΟΝΙΚΗ ΔΙΑΚΥΒΕΡΝΗΣΗ", "defense": "ΕΘΝΙΚΗ ΑΜΥΝΑ", "immigration": "ΑΛΛΟΔΑΠΟΙ ΚΑΙ ΜΕΤΑΝΑΣΤΕΥΣΗ",
}
# Volumes that keywords alone give, folded when used.
MORE_VOLUMES = [
    ("ΓΕΩΡΓΙΚΗ ΝΟΜΟΘΕΣΙΑ", ["γεωργικ", "αγροτικ"]),
    ("ΕΜΠΟΡΙΚΗ ΝΑΥΤΙΛΙΑ", ["ναυτιλ", "πλοίο", "λιμεν"]),
    ("ΕΚΚΛΗΣΙΑΣΤΙΚΗ ΝΟΜΟΘΕΣΙΑ", ["εκκλησ", "μητροπόλ", "ιερά σύνοδο"]),
    ("ΔΗΜΟΣΙΑ ΕΡΓΑ", ["δημόσια έργα", "οδοποιί"]),
    ("ΟΡΓΑΝΙΣΜΟΙ ΤΟΠΙΚΗΣ ΑΥΤΟΔΙΟΙΚΗΣΗΣ", ["τοπικής αυτοδιοίκησης", "δημοτικό συμβούλιο", "περιφερειάρχ"]),
]
# What in a title speaks for a category, folded when used.
SIGNALS = {
    "amendment": ["τροποποίηση", "τροποποιείται", "τροποποιούνται", "αντικατάσταση", "αντικαθίσταται", "καταργείται"],
    "codification": ["κωδικοποίηση", "κωδικοποιητικ", "κωδικοποιούμεν", "κώδικας"],
    "ratification": ["κύρωση", "επικύρωση", "κυρώνεται", "συνθήκη", "πρωτόκολλο", "διεθν συμβ"],
    "organizational": ["οργανισμός", "διάρθρωση", "σύσταση", "οργάνωση", "κατανομή θέσε"],
    "regulatory": ["κανονισμός", "κανονιστικ", "ρύθμιση", "καθορισμός", "καθορισμ"],
    "enforcement": ["εφαρμογή", "εκτέλεση", "εφαρμοστικ"],
}


def plain_fold(word: str) -> str:
    """What ``fold`` makes of a literal."""
    low = unicodedata.normalize("NFD", word.lower().replace("ς", "σ"))
    return "".join(c for c in low if unicodedata.category(c) != "Mn")


def matching(text: Column, rules: list[tuple[str, str]], flags: str = "(?iuU)") -> Column:
    """Labels whose pattern is in the text, in the order of the rules, each once."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(text.rlike(flags + p), F.lit(label)) for p, label in rules])))


def containing(text: Column, words: list[tuple[str, list[str]]]) -> Column:
    """Labels of which a word is in the text, in their order."""
    has = lambda ws: _any([text.contains(w) for w in ws])
    return F.array_compact(F.array(*[F.when(has(ws), F.lit(label)) for label, ws in words]))


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def domains(text: Column, title: Column | None = None) -> Column:
    """Domains of a provision: by cited codes in title and text, else by keywords in the text without ministries' portfolios."""
    t = F.coalesce(text, F.lit(""))
    whole = t if title is None else F.concat_ws("\n", F.nullif(title, F.lit("")), t)
    precise = matching(whole, CODES)
    folded = fold(F.regexp_replace(t, PORTFOLIO, " "))
    return F.when(F.size(precise) > 0, precise).otherwise(containing(folded, KEYWORDS))


def join_dictionary(docs: DataFrame, dictionary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, labels: docs against a (keyword, label) table whose size is checked; a larger one than a thousand rows is split by its first words' hash join.

    The dictionary is collected (a bounded vocabulary) and unrolled into one pass of ``contains``, so there is no nested-loop join.
    """
    rows = dictionary.limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("a vocabulary of over 1000 keywords: match by tokens instead")
    words: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["label"], r["keyword"])):
        words.setdefault(r["label"], []).append(r["keyword"])
    labels = containing(F.lower(F.coalesce(text_col, F.lit(""))), list(words.items())) if words else F.array().cast("array<string>")
    return docs.select(id_col, labels.alias("labels"))


def volumes(text: Column, title: Column | None = None) -> Column:
    """Volumes of the subject index: those of the domains, then those of keywords in the text without portfolios."""
    mapped = F.transform(domains(text, title), lambda d: _case(d, VOLUMES))
    folded = fold(F.regexp_replace(F.coalesce(text, F.lit("")), PORTFOLIO, " "))
    return F.array_distinct(F.concat(mapped, containing(folded, [(v, [plain_fold(w) for w in ws]) for v, ws in MORE_VOLUMES])))


def _case(value: Column, table: dict[str, str]) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(value == k, v)
    return out.otherwise(None)


def signal(folded: Column, kind: str) -> Column:
    return _any([folded.contains(plain_fold(w)) for w in SIGNALS[kind]])


def document_categories(instruments: DataFrame, provisions: DataFrame) -> DataFrame:
    """instrument_id, document_category by type, signals in the title, and the provisions' headings and books.

    instruments: instrument_id, instrument_type, title. provisions: instrument_id, text, book.
    """
    p = provisions.groupBy("instrument_id").agg(
        F.count_if(signal(fold(F.left(F.coalesce("text", F.lit("")), F.lit(160))), "amendment")).alias("amending"),
        F.coalesce(F.bool_or(F.coalesce("book", F.lit("")) != ""), F.lit(False)).alias("deep"),
    )
    x = instruments.join(p, "instrument_id", "left").fillna({"amending": 0, "deep": False}).withColumn("__t", fold(F.coalesce("title", F.lit(""))))
    has = lambda k: signal(F.col("__t"), k)
    kind, deep = F.col("instrument_type"), F.col("deep")
    law = F.when(has("ratification"), "NOMOS_RATIFICATION").when(has("codification"), "NOMOS_CODIFICATION").when(has("amendment") | (F.col("amending") >= 3), "NOMOS_AMENDMENT").when(deep, "NOMOS_CODIFICATION").otherwise("NOMOS_SUBSTANTIVE")
    decree = F.when(has("organizational"), "PD_ORGANIZATIONAL").when(has("codification") | deep, "PD_CODIFICATION").when(has("amendment"), "PD_AMENDMENT").when(has("enforcement"), "PD_ENFORCEMENT").otherwise("PD_REGULATORY")
    decision = F.when(has("organizational"), "YA_ORGANIZATIONAL").when(has("regulatory") | (kind == "KAN_APOFASI"), "YA_REGULATORY").otherwise("YA_INDIVIDUAL")
    out = (
        F.when(kind.isin("NOMOS", "AN", "ND"), law).when(kind == "PD", decree).when(kind.isin("PNP", "PSIFISMA", "KYA", "ANAKOINOSI", "PYS"), kind)
        .when(kind.isin("YA", "KAN_APOFASI", "APOFASI_DIOIKITI", "APOFASI_PERIF", "APOFASI_NPDD"), decision).otherwise("UNKNOWN")
    )
    return x.select("instrument_id", out.alias("document_category"))


def category(kind: Column, n_lines: Column, n_returned: Column, total: Column) -> Column:
    """A decision tree over a header and counts of its children; the first rule that holds names the category."""
    return F.when(n_lines == 0, "empty").when(n_returned >= 3, "codification").when((kind == "F") & (total > 200_000), "framework").when(n_returned > 0, "amending").when(kind == "P", "provisional").otherwise("ordinary")
