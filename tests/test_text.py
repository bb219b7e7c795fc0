import unicodedata

import pytest
from pyspark.sql import functions as F

from statuta.functions import keys, quality, tables, text


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "column, given, wanted",
    [
        (text.fix_glyphs, "∆ιαδικασία ’α’", "Διαδικασία 'α'"),
        (text.dehyphenate, "αποκλεισμέ-\nνους 2019/\n1151", "αποκλεισμένους 2019/1151"),
        (text.undouble, "ΟΟΡΡΟΟΙΙ και ΜΜ..ΔΔ..ΕΕ.. «ααββγγ», 112233 σσ", "ΟΡΟΙ και Μ.Δ.Ε. «αβγ», 112233 σσ"),
        (text.display, "  α  β\n\n\n\nγ ", "α β\n\nγ"),
        (text.fold, "Άρθρο ΪΣΧΎΟΣ τέλος École", "αρθρο ισχυοσ τελοσ ecole"),
        (text.repair_capitals, "ANΘPΩΠOΣ", "ΑΝΘΡΩΠΟΣ"),
        (text.repair_capitals, "Anθ", "Anθ"),
        (text.mixed_script, "ΝOΜΟΣ (cid:12)COVID ∆ικη", "ΝΟΜΟΣ  COVID Δικη"),
        (text.first_line, "\n  \n α \nβ", "α"),
        (text.unquote, "«με την επωνυμία «Ε.Α.Κ.» του φορέα»", "με την επωνυμία «Ε.Α.Κ.» του φορέα"),
        (text.strip_furniture, "α\n*01000231402240020*\n12 ΕΦΗΜΕΡΙΔΑ ΤΗΣ ΚΥΒΕΡΝΗΣΕΩΣ\nβ\nΑΠΟ ΤΟ ΕΘΝΙΚΟ ΤΥΠΟΓΡΑΦΕΙΟ\nγ", "α\n\nβ"),
        (text.strip_furniture, "Άρθρο 1 στο Εθνικό Τυπογραφείο\nE 5666\nτέλος", "Άρθρο 1 στο Εθνικό Τυπογραφείο\n\nτέλος"),
        (text.language, "η απόφαση του υπουργού law", "el"),
        (text.language, "the law", "en"),
        (text.language, "123", "el"),
        (text.language, "νόμος άρθρο the law", "mixed"),
        (text.cid_ratio, "(cid:1) α (cid:2) β", 0.5),
    ],
)
def test_text(spark, column, given, wanted):
    assert one(spark, column, given) == wanted


def test_fold_agrees_with_decomposition(spark):
    chars = "".join(chr(c) for c in [*range(0x20, 0x250), *range(0x370, 0x400), *range(0x1F00, 0x2000)] if unicodedata.category(chr(c)) not in ("Cn", "Cc"))
    plain = "".join(c for c in unicodedata.normalize("NFD", chars.lower().replace("ς", "σ")) if unicodedata.category(c) != "Mn")
    got = one(spark, text.fold, chars)
    assert unicodedata.normalize("NFC", plain) == unicodedata.normalize("NFC", got)


@pytest.mark.parametrize("family", [["διάταξη", "διατάξεων", "διατάξεις"], ["καταργείται", "καταργούνται"], ["νόμος", "νόμου", "νόμων"]])
def test_stems_of_a_family_fall_together(spark, family):
    assert len({one(spark, text.stem, w) for w in family}) == 1


def test_stem_strips_to_a_fixed_point(spark):
    def slow(w):
        while len(w) > text.STEM:
            hit = next((e for e in sorted(text.ENDINGS, key=len, reverse=True) if w.endswith(e) and len(w) - len(e) >= text.STEM), None)
            if hit is None:
                return w
            w = w[: -len(hit)]
        return w

    words = "τροποποιηση διαταξεων κανονισμοσ ων και φορολογουμενων εκδοσεωσ 12 law υπουργοσ".split()
    got = one(spark, text.stem, " ".join(words)).split()
    assert got == [slow(w) if w[0] > "z" else w for w in words]
    assert one(spark, text.stem, "") == "" and one(spark, text.stem, None) is None


def test_quality(spark):
    good = one(spark, quality.score, "Το παρόν άρθρο ρυθμίζει τις προϋποθέσεις εφαρμογής του νόμου. " * 3)
    assert good["score"] == 100 and good["is_valid"] and good["reason"] == ""
    cid = one(spark, quality.score, "(cid:12) " * 120)
    assert cid["score"] < 40 and cid["reason"].startswith("CID-keyed font")
    assert one(spark, quality.score, "? " * 60)["reason"].startswith("ASCII-substitution garble")
    assert one(spark, quality.score, "short")["reason"] == "text too short (<50 chars)"
    assert one(spark, quality.score, "The parties agree to the following terms of this treaty, in force.")["is_valid"]
    assert one(spark, quality.needs_recognition, "short")["need"]


def test_tables(spark):
    md = "α\n| a | b |\n| --- | :-: |\n| 1 | 2 |\nβ | γ\n| x | y |\n| z | w |"
    assert one(spark, tables.tables, md) == [[["a", "b"], ["1", "2"]], [["x", "y"], ["z", "w"]]]
    assert one(spark, tables.tables_json, "no | table") is None
    rows = spark.createDataFrame([([["a", None], ["b\nc"]],)], "x array<array<string>>")
    assert rows.select(tables.to_markdown(F.col("x"))).first()[0] == "| a |  |\n| --- | --- |\n| b c |  |"


def test_keys(spark):
    import uuid

    row = spark.range(1).select(
        keys.instrument_id(F.lit("PD"), F.lit(62), F.lit(2025)).alias("a"), keys.instrument_key(F.lit("NOMOS"), F.lit(4675), F.lit(2024)).alias("b"),
        keys.decision_id(F.lit("Β"), F.lit("913"), F.lit(2025), F.lit(1)).alias("c"), keys.dated_id(F.lit("PNP"), F.lit("Α"), F.lit("132"), F.lit(2023)).alias("d"),
        keys.provision_id(F.lit("ν.1/2000"), F.lit("24"), F.lit("2"), F.lit("α")).alias("e"), keys.uuid5(F.lit("Β΄913/2025#1")).alias("f"),
        keys.article_level(F.lit("Β΄913/2025#1#αρ.5.παρ.2")).alias("g"), keys.law_of(F.lit("Β΄913/2025#1#αρ.5")).alias("h"), keys.law_number(F.lit("π.δ.62/2025")).alias("i"),
        keys.greek_date(F.lit("στις 3 Κάτι 2020, 26 Μαρτίου 2024")).alias("j"), keys.rfc3339(F.lit("2024-03-26")).alias("k"), keys.version_key(F.lit("a"), F.lit(None)).alias("l"),
    ).first()
    assert list(row) == ["π.δ.62/2025", "N4675/2024", "Β΄913/2025#1", "Π.Ν.Π. Α΄132/2023", "ν.1/2000#αρ.24.παρ.2.περ.α", str(uuid.uuid5(uuid.NAMESPACE_DNS, "Β΄913/2025#1")), "Β΄913/2025#1#αρ.5", "Β΄913/2025#1", "62/2025", "2024-03-26", "2024-03-26T00:00:00Z", "a@enacted"]
    c = one(spark, keys.citation, "τι ισχύει για το άρθρο 5 παρ. 2 του π.δ. 62/2025;")
    assert (c["article"], c["paragraph"], c["instrument_id"]) == ("5", "2", "π.δ.62/2025")
    assert one(spark, keys.citation, "article 7 of law 4412/2016")["instrument_key"] == "N4412/2016"
    assert one(spark, keys.citation, "ν. 4412/2016") is None
