from pyspark.sql import functions as F

from statuta.operators import chunks, edges, identify, parse

ISSUE = """ΕΦΗΜΕΡΙΔΑ ΤΗΣ ΚΥΒΕΡΝΗΣΕΩΣ
26 Μαρτίου 2024 ΤΕΥΧΟΣ ΠΡΩΤΟ Αρ. Φύλλου 52
ΝΟΜΟΣ ΥΠ' ΑΡΙΘΜ. 5090
Ρυθμίσεις για την
αγορά Η ΠΡΟΕΔΡΟΣ ΤΗΣ ΕΛΛΗΝΙΚΗΣ ΔΗΜΟΚΡΑΤΙΑΣ
ΜΕΡΟΣ ΠΡΩΤΟ
ΚΕΦΑΛΑΙΟ Α'
Άρθρο 1
Σκοπός
Σκοπός του παρόντος είναι η ρύθμιση.
Άρθρο 2
Τροποποίηση άρθρου 24 ν. 4675/2024
Η παρ. 2 του άρθρου 24 του ν. 4675/2024 αντικαθίσταται ως εξής: «2. Το νέο κείμενο της παραγράφου ισχύει.
Άρθρο 24Α
Ξένο άρθρο»
ΚΕΦΑΛΑΙΟ Β'
Άρθρο 3
Καταργούμενες
Ο ν. 1234/2000 καταργείται.
ΠΑΡΑΡΤΗΜΑ
Πρώτο
ΠΑΡΑΡΤΗΜΑ
Δεύτερο"""


def test_masthead(spark):
    m = spark.createDataFrame([(ISSUE,)], "x string").select(identify.masthead(F.col("x")).alias("m")).first()["m"]
    assert (m["instrument_type"], m["number"], m["year"], m["fek_series"], m["fek_number"], m["fek_date"], m["title"], m["warnings"]) == ("NOMOS", 5090, 2024, "Α", "52", "2024-03-26", "Ρυθμίσεις για την αγορά", [])
    below = spark.createDataFrame([("ΝΟΜΟΣ ΥΠ' ΑΡΙΘΜ.\n5091\nΤίτλος\n\nα",), ("τίποτα",), ("ΠΡΑΞΗ ΝΟΜΟΘΕΤΙΚΟΥ ΠΕΡΙΕΧΟΜΕΝΟΥ\n",), (None,)], "x string")
    got = [r["m"] for r in below.select(identify.masthead(F.col("x")).alias("m")).collect()]
    assert got[1]["instrument_type"] is None and "instrument_type not found in masthead" in got[1]["warnings"]
    assert got[2]["instrument_type"] == "PNP" and "instrument number not found" not in got[2]["warnings"]
    assert got[3]["instrument_type"] is None


def test_segments_keep_the_hierarchy_and_leave_quoted_articles(spark):
    acts = spark.createDataFrame([("ν.5090/2024", ISSUE), ("Β΄1/2024", "Μία απόφαση."), ("κενό", "  ")], "instrument_id string, text string")
    rows = parse.segment(acts).orderBy("instrument_id", "chunk_index").collect()
    law = [r for r in rows if r["instrument_id"] == "ν.5090/2024"]
    assert [r["canonical_id"] for r in law] == ["ν.5090/2024#αρ.1", "ν.5090/2024#αρ.2", "ν.5090/2024#αρ.3", "ν.5090/2024#παραρτ", "ν.5090/2024#παραρτ.2"]
    assert law[0]["hierarchy_path"] == "ν.5090/2024 > ΜΕΡΟΣ ΠΡΩΤΟ > ΚΕΦΑΛΑΙΟ Α' > Άρθρο 1" and law[2]["chapter"] == "Β'"
    assert law[1]["article_title"].startswith("Τροποποίηση") and "Ξένο" in law[1]["text"]
    assert {r["total_chunks"] for r in law} == {5} and [r["chunk_index"] for r in law] == [0, 1, 2, 3, 4]
    whole = [r for r in rows if r["instrument_id"] == "Β΄1/2024"]
    assert [(r["canonical_id"], r["chunk_type"]) for r in whole] == [("Β΄1/2024#full", "document")]
    assert not [r for r in rows if r["instrument_id"] == "κενό"]


def test_amendments(spark):
    acts = spark.createDataFrame([("ν.5090/2024", ISSUE)], "instrument_id string, text string")
    e = edges.clean(parse.amendments(parse.segment(acts)), own="ν.5090/2024").orderBy("ordinal").collect()
    assert [(r["action"], r["target_id"], r["scope"], r["resolved"]) for r in e] == [("replaces", "ν.4675/2024#αρ.24.παρ.2", "paragraph", True), ("repeals", "ν.1234/2000", "document", True)]
    told = spark.createDataFrame([("του άρθρου 18 της υπ’ αρ. 3/100/21.12.2023 (Β΄ 7738) απόφασης",), ("της περ. β της παρ. 3 του άρθρου 7",), ("του π.δ. 12/1999",), ("",)], "w string")
    got = [tuple(r["r"]) for r in told.select(parse.reference(F.col("w"), F.lit("own")).alias("r")).collect()]
    assert got == [("Β΄7738/2023#αρ.18", "article", True), ("own#αρ.7.παρ.3.περ.β", "case", True), ("π.δ.12/1999", "document", True), ("own", "document", False)]


def test_quotes_that_lost_their_end():
    text = "Άρθρο 1\n«αρχή\nΆρθρο 2\nκείμενο»\nΆρθρο 3\nτέλος"
    assert [m[3] for m in parse.headings(text)] == ["1", "2", "3"]
    inserted = "Άρθρο 1\nπροστίθεται «Άρθρο 40Α\nΆρθρο 40Β\nνέο»\nΆρθρο 2\nτέλος"
    assert [m[3] for m in parse.headings(inserted)] == ["1", "2"]
    code = "Άρθρο πρώτο\nΚυρώνεται «\n" + "".join(f"Άρθρο {k}\nδιάταξη του κώδικα με αρκετό κείμενο\n" for k in range(1, 9)) + "»"
    assert [m[3] for m in parse.headings(code)] == ["πρώτο", *map(str, range(1, 9))]


def test_nested_and_stray_quote_marks():
    text = "» «α «β» γ» » «δ"
    assert [tuple(q) for q in parse.quotes(text).itertuples(index=False)] == [(2, 10, True), (5, 7, True), (14, 16, False)]
    assert parse.masks(text) == [(2, 10), (14, 16)] and parse.masks("χωρίς") == []
    far = "«αρχή\n" + "λέξη " * 3000 + "\nΆρθρο 5\n«άλλο»"
    assert parse.masks(far) == [(0, far.index("Άρθρο 5"))]


def test_delegations(spark):
    rows = [("Β΄1/2024", "YA", "τίτλος", "Έχοντας υπόψη: την παρ. 2 του άρθρου 5 του ν. 4412/2016, αποφασίζουμε: τις διατάξεις του άρθρου 9 του ν. 1/2001"), ("ν.1/2024", "NOMOS", "", "κατ' εξουσιοδότηση του άρθρου 5 του ν. 4412/2016")]
    got = parse.delegations(spark.createDataFrame(rows, "instrument_id string, instrument_type string, title string, text string")).collect()
    assert [(r["implementing_id"], r["enabling_id"], r["enabling_article_number"]) for r in got] == [("Β΄1/2024", "ν.4412/2016#αρ.5.παρ.2", "5")]


def test_acts_of_an_issue(spark):
    text = "ΑΠΟΦΑΣΕΙΣ\nΑριθμ. 12/101 (1)\nΠρώτη απόφαση\nΟΙ ΥΠΟΥΡΓΟΙ\nκείμενο\nΑριθμ. Φ.5 (2)\nΔεύτερη\nΟ ΔΗΜΑΡΧΟΣ\nκείμενο\nΑριθμός Εισακτέων\n"
    head = "26 Μαρτίου 2024 ΤΕΥΧΟΣ ΔΕΥΤΕΡΟ Αρ. Φύλλου 913\n"
    issues = spark.createDataFrame([("a", head + text)], "doc_id string, text string").withColumn("masthead", identify.masthead(F.col("text")))
    acts = parse.identify(parse.split_acts(issues), issues).orderBy("seq").collect()
    assert [(r["instrument_type"], r["number"], r["item"], r["title"], r["instrument_id"]) for r in acts] == [("KYA", "12/101", 1, "Πρώτη απόφαση", "Β΄913/2024#1"), ("APOFASI_PERIF", "Φ.5", 2, "Δεύτερη", "Β΄913/2024#2")]


def test_european_references(spark):
    df = spark.createDataFrame([("του Κανονισμού (ΕΕ) 2022/868, της Οδηγίας 2011/83/ΕΕ και πάλι Κανονισμός (ΕΕ) 2022/868",), (None,)], "x string")
    assert [r[0] for r in df.select(edges.eu_references(F.col("x"))).collect()] == [["ΕΕ:Κανονισμός 2022/868", "ΕΕ:Οδηγία 2011/83"], []]


def test_chunks(spark):
    text = "α β\nγ\n\n1. πρώτο\n2. δεύτερο\n| a | b |\n| 1 | 2 |\nτέλος"
    df = spark.createDataFrame([(text, "x" * 4500, "p" * 900 + "\n\n" + "q" * 1200 + "\n\n" + "r" * 700)], "a string, b string, c string")
    row = df.select(chunks.paragraphs(F.col("a")), chunks.sections(F.col("b")), chunks.sections(F.col("c")), chunks.windows(F.array(*map(F.lit, [10, 20, 5, 30, 40])), 35), chunks.split_oversized(F.col("c"), 1000)).first()
    assert row[0] == ["α β\nγ", "1. πρώτο", "2. δεύτερο", "| a | b |\n| 1 | 2 |", "τέλος"]
    assert [len(x) for x in row[1]] == [2000, 2000, 500] and [len(x) for x in row[2]] == [900, 1902]
    assert row[3] == [0, 0, 0, 1, 2] and max(map(len, row[4])) <= 1500 and "".join(row[4]).replace("\n", "") == ("p" * 900 + "q" * 1200 + "r" * 700)
