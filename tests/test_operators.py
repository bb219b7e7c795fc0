from datetime import date

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statuta.operators import classify, quality, search, store, timeline
from statuta.plans import ingest
from statuta.sources import files, layout, providers
from statuta.streaming import ingest as streaming
from tests.test_parse import ISSUE

EDGES = "target_id string, effective_date date, ordinal int, source_law string, action string, text string"


def assembled(spark, edges, articles=(), documents=(("ν.1/2000", date(2000, 1, 1)),), **how):
    v, c = timeline.assemble(
        spark.createDataFrame(list(edges), EDGES), spark.createDataFrame(list(articles), "aid string, valid_from date, text string"),
        spark.createDataFrame(list(documents), "law string, publication_date date"), **how,
    )
    return [tuple(r) for r in v.orderBy("aid", "version").collect()], c.first().asDict()


A = "ν.1/2000#αρ.15"
BASE = [(A, date(2000, 1, 1), "enacted")]


def test_a_replacement_closes_the_window(spark):
    v, c = assembled(spark, [(A, date(2024, 4, 1), 1, "2/2024", "replaces", "«new»"), (A + ".παρ.2", date(2024, 5, 1), 2, "2/2024", "replaces", "x")], BASE)
    assert v == [(A, 1, date(2000, 1, 1), date(2024, 4, 1), False, "in_force", "enacted"), (A, 2, date(2024, 4, 1), None, True, "amended", "new")]
    assert c == {"articles": 1, "versions_written": 1, "pending": 0, "linked_subedits": 1}


def test_edges_wait_for_their_law_and_articles_may_begin_with_an_edit(spark):
    e = [(A, date(2024, 4, 1), 1, "2/2024", "replaces", "x")]
    assert assembled(spark, e, BASE, [])[1]["pending"] == 1
    assert assembled(spark, e, [])[1]["pending"] == 1
    v, c = assembled(spark, [(A, date(2024, 4, 1), 1, "2/2024", "adds", "«added»"), (A, date(2024, 6, 1), 2, "3/2024", "adds", "more"), (A, date(2025, 1, 1), 1, "4/2025", "repeals", None), (A, date(2026, 1, 1), 1, "5/2026", "replaces", "late")], [])
    assert [(r[1], r[5], r[6]) for r in v] == [(1, "in_force", "added"), (2, "amended", "added\nmore"), (3, "repealed", "added\nmore")]
    assert c["versions_written"] == 3


def test_same_day_edits(spark):
    e = [(A, date(2024, 4, 1), 1, "2/2024", "replaces", "one"), (A, date(2024, 4, 1), 2, "2/2024", "replaces", "two"), (A, date(2025, 1, 1), 1, "3/2025", "adds", "three")]
    assert [r[6] for r in assembled(spark, e, BASE)[0]] == ["enacted", "two", "two\nthree"]
    stored = assembled(spark, e, BASE, as_stored=True)[0]
    assert [(r[5], r[6]) for r in stored] == [("in_force", "enacted"), ("in_force", "one"), ("amended", "two\nthree")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 28), st.sampled_from(["replaces", "adds", "repeals"]), st.sampled_from(["a", "b", ""])), min_size=1, max_size=6), st.randoms())
def test_the_order_of_rows_does_not_matter_and_windows_touch(spark, edits, random):
    rows = [(A, date(2024, 1, d), k, "2/2024", a, x) for k, (d, a, x) in enumerate(edits)]
    once = assembled(spark, rows, BASE)[0]
    random.shuffle(rows)
    assert assembled(spark, rows, BASE)[0] == once
    assert all(x[3] == y[2] for x, y in zip(once, once[1:])) and once[-1][4]


def test_point_in_time(spark):
    v = spark.createDataFrame([("a", 1, date(2000, 1, 1), date(2001, 1, 1), False, "in_force"), ("a", 2, date(2001, 1, 1), None, True, "repealed")], "aid string, version int, valid_from date, valid_to date, is_current boolean, status string")
    assert [r["version"] for r in timeline.as_of(v, "2000-12-31").collect()] == [1] and [r["version"] for r in timeline.as_of(v, "2001-01-01").collect()] == [2]
    assert timeline.current(v).count() == 0


def test_store(spark, tmp_path):
    s = files.Store(spark, str(tmp_path / "store"))
    assert s.count("t") == -1
    rows = lambda *x: spark.createDataFrame(x, "k int, a string, b int")
    s.upsert("t", rows((1, "x", 1), (2, "y", 2)), ["k"])
    s.upsert("t", rows((2, None, 5), (3, "z", 3)), ["k"], patch=True)
    assert sorted(map(tuple, s.read("t").drop("tenant").collect())) == [(1, "x", 1), (2, "y", 5), (3, "z", 3)]
    other = files.Store(spark, str(tmp_path / "store"), "cy")
    assert other.count("t") == 0 and s.reset("t") == 3 and s.count("t") == 0
    stored = rows((1, "x", 1), (2, "y", 2))
    assert sorted(map(tuple, store.patch_existing(stored, spark.createDataFrame([(1, ""), (2, "n"), (9, "q")], "k int, a string"), "k").collect())) == [(1, "x", 1), (2, "n", 2)]
    assert sorted(r["k"] for r in store.new_keys(stored, rows((2, "", 0), (3, "", 0)), ["k"]).collect()) == [3]


def test_states(spark):
    state = spark.createDataFrame([("a", "h1", "done", "load", None, 1.0), ("b", "h2", "processing", "x", None, None), ("c", "h9", "review", None, "e", None)], "doc_id string, content_hash string, status string, stage string, error string, confidence double")
    batch = spark.createDataFrame([("d", "h1"), ("b", "h2"), ("e", "h3"), ("f", "h3")], "doc_id string, content_hash string")
    assert [r["doc_id"] for r in store.claim(batch, state).collect()] == ["e"]
    changed = store.set_status(state, spark.createDataFrame([("c", "pending", None, None, 0.8)], "doc_id string, status string, stage string, error string, confidence double"))
    assert tuple(changed.where("doc_id = 'c'").first()) == ("c", "h9", "pending", None, None, 0.8)
    assert [r["status"] for r in store.requeue_stale(state).orderBy("doc_id").collect()] == ["done", "pending", "review"]
    assert [r["doc_id"] for r in store.pending(store.requeue_stale(state)).collect()] == ["b", "c"]


def test_files(spark, tmp_path):
    for name in ("a.pdf", "x/b.pdf", "x/y/c.pdf", "x/d.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    found = files.scan(spark, str(tmp_path))
    assert [(r["folder"], r["n_files"]) for r in files.by_folder(found).orderBy("folder").collect()] == [("(root)", 1), ("x", 2)]
    read = files.pages(found, lambda c: [{"raw_text": c.decode()}, {"raw_text": None}])
    assert sorted((r["doc_id"], r["page"], r["raw_text"]) for r in read.collect())[0] == ("a.pdf", 1, "a.pdf")
    good = "Το παρόν άρθρο ρυθμίζει τις προϋποθέσεις εφαρμογής του νόμου. " * 3
    pages = spark.createDataFrame([("d", 1, good), ("d", 2, "(cid:1) " * 99), ("d", 3, "short")], "doc_id string, page int, raw_text string")
    ocr = spark.createDataFrame([("d", 3, "recognised")], "doc_id string, page int, markdown string")
    r = files.extract(pages, ocr).first()
    assert (r["text"], r["class"], r["ocr_pages"], r["corrupt_pages"]) == (good + "\n\nrecognised", "mixed", [2, 3], [2])


def box(text, x, top, width=60.0):
    return (text, x, x + width, top)


def test_two_columns_are_read_one_after_the_other(spark):
    left = [box(f"l{k}", 50, 20 * k, 255) for k in range(10)]
    right = [box(f"r{k}", 310, 20 * k + 1) for k in range(10)]
    frame = pd.DataFrame([x for p in zip(left, right) for x in p], columns=["text", "x0", "x1", "top"])
    assert layout.page_text(frame, 600).split("\n") == [f"l{k}" for k in range(10)] + [f"r{k}" for k in range(10)]
    assert layout.gutter(frame["x0"].to_numpy(), frame["x1"].to_numpy(), 600) == 310
    words = spark.createDataFrame([("d", 1, 600.0, r[0], *map(float, r[1:])) for r in frame.itertuples(index=False)], "doc_id string, page int, width double, text string, x0 double, x1 double, top double")
    assert layout.pages_from_words(words).first()["raw_text"].startswith("l0\nl1")


def test_full_rows_part_the_bands():
    rows = [box("title", 100, 0, 400)] + [b for k in range(4) for b in (box(f"l{k}", 50, 20 + 20 * k), box(f"r{k}", 320, 20 + 20 * k))] + [box("middle", 100, 100, 400), box("l9", 50, 120), box("r9", 320, 120)]
    frame = pd.DataFrame(rows, columns=["text", "x0", "x1", "top"])
    assert layout.page_text(frame, 600).split("\n") == ["title", "l0", "l1", "l2", "l3", "r0", "r1", "r2", "r3", "middle", "l9", "r9"]
    assert layout.page_text(frame.iloc[:3], 600).split("\n") == ["title", "l0 r0"] and layout.page_text(frame.iloc[:0], 600) == ""


def test_providers(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "yy")], "k string, t string")
    cache = spark.createDataFrame([("a" * 64, 1)], "content_hash string, n int")
    assert sorted((r["k"], r["n"]) for r in providers.ask(df, "k", "t", lambda ts: [len(t) for t in ts], "n", "int", cache=cache).collect()) == [("a", 1), ("b", 1), ("c", 2)]
    waits, calls = [], iter([RuntimeError("429 rate limit"), RuntimeError("timeout"), None])

    def f():
        e = next(calls)
        if e:
            raise e
        return "done"

    assert providers.retried(f, sleep=waits.append) == "done" and len(waits) == 2 and waits[1] > 2
    with pytest.raises(ValueError):
        providers.retried(lambda: (_ for _ in ()).throw(ValueError("bad")), sleep=waits.append)
    now = [0.0]
    b = providers.Bucket(2, 2, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(4):
        b.take()
    assert now[0] == pytest.approx(1.0)
    v = spark.createDataFrame([("ο νόμος του νόμου",), ("",)], "x string").select(providers.hashed_embedding(F.col("x"), 64).alias("v")).collect()
    assert np.linalg.norm(v[0]["v"]) == pytest.approx(1, abs=1e-6) and not any(v[1]["v"])
    j = spark.createDataFrame([('noise {"a": 1} more',), ("null",)], "x string")
    assert j.select(providers.lenient_json(F.col("x"), "a int").alias("j")).first()["j"]["a"] == 1
    assert [r[0] for r in j.select(providers.nothing(F.col("x"))).collect()] == ['noise {"a": 1} more', ""]


def test_streaming_folds_edges_as_their_laws_come(spark, tmp_path):
    s = files.Store(spark, str(tmp_path / "store"))
    s.write("articles", spark.createDataFrame(BASE, "aid string, valid_from date, text string"))
    s.write("documents", spark.createDataFrame([("ν.9/1999", date(1999, 1, 1))], "law string, publication_date date"))
    edges = spark.createDataFrame([(A, date(2024, 4, 1), 1, "2/2024", "replaces", "new")], EDGES)
    edges.write.parquet(str(tmp_path / "in"))
    run = lambda: streaming.stream_edges(spark, str(tmp_path / "in"), EDGES, s, str(tmp_path / "ckpt")).awaitTermination()
    run()
    assert s.read("amendments").count() == 1 and s.count("versions") == 0
    s.upsert("documents", spark.createDataFrame([("ν.1/2000", date(2000, 1, 1))], "law string, publication_date date"), ["law"])
    streaming.consolidate(s)
    assert s.count("versions") == 2
    streaming.edge_batch(s)(edges, 7)  # a batch that comes twice
    assert s.count("versions") == 2 and s.count("amendments") == 1


def test_search(spark):
    docs = spark.createDataFrame([(1, "tax law tax"), (2, "law of the sea"), (3, "nothing here"), (4, None)], "id int, text string")
    assert [r["id"] for r in search.bm25(docs, ["tax", "law"], "id", "text").collect()] == [1, 2]
    assert search.bm25(docs, ["absent"], "id", "text").count() == 0
    tok = docs.where("id = 2").select(search.trigrams(F.lit("abcd")), search.field(F.lit(" a b ")), search.whitespace(F.lit("A-b c"))).first()
    assert list(tok) == [["abc", "bcd"], ["a b"], ["a-b", "c"]]


def test_classification(spark):
    df = spark.createDataFrame([("Η σύμβαση του ν. 4412/2016 και ο Ποινικός Κώδικας",), ("η κληρονομια και το νοσοκομειο",), ("Ο Υπουργός Υγείας και Παιδείας αποφασίζει",), (None,)], "x string")
    assert [r[0] for r in df.select(classify.domains(F.col("x"))).collect()] == [["criminal", "public_procurement"], ["civil", "health"], [], []]
    assert df.select(classify.volumes(F.lit("γεωργική σύμβαση"))).first()[0] == ["ΑΣΤΙΚΗ ΝΟΜΟΘΕΣΙΑ", "ΓΕΩΡΓΙΚΗ ΝΟΜΟΘΕΣΙΑ"]
    i = spark.createDataFrame([("a", "NOMOS", "Κύρωση συνθήκης"), ("b", "NOMOS", "Άλλα"), ("c", "PD", "Οργανισμός υπουργείου"), ("d", "KAN_APOFASI", ""), ("e", None, "")], "instrument_id string, instrument_type string, title string")
    p = spark.createDataFrame([("b", "Τροποποίηση άρθρου", "")] * 3, "instrument_id string, text string, book string")
    assert {r[0]: r[1] for r in classify.document_categories(i, p).collect()} == {"a": "NOMOS_RATIFICATION", "b": "NOMOS_AMENDMENT", "c": "PD_ORGANIZATIONAL", "d": "YA_REGULATORY", "e": "UNKNOWN"}


def test_reports(spark):
    g, p = (spark.createDataFrame([(x,) for x in xs], "k int") for xs in ([1, 2, 3, 3], [2, 3, 4]))
    r = quality.prf(g, p, ["k"]).first()
    assert (r["tp"], r["fp"], r["fn"], r["precision"], r["f1"]) == (2, 1, 1, 0.666667, 0.666667)
    assert quality.prf(g.limit(0), p.limit(0), ["k"]).first()["f1"] == 0.0
    prov = spark.createDataFrame([("a", "article", "1", "x", 0), ("a", "article", "1", "μεγάλο κείμενο με Aρθρο αρκετό", 1)], "instrument_id string, chunk_type string, article_no string, text string, chunk_index int")
    inst = spark.createDataFrame([("a", True, False), ("b", False, True)], "instrument_id string, identified boolean, ocr_degraded boolean")
    assert {x[0]: x[1] for x in quality.flags(prov, inst).collect()} == {"a": ["duplicate_articles", "short_bodies", "homoglyphs"], "b": ["no_articles", "unresolved", "ocr_degraded"]}


def test_the_whole_way(spark):
    k = ingest.run(spark.createDataFrame([("a", ISSUE), ("b", "τίποτα"), ("c", None)], "doc_id string, text string"))
    assert [r["instrument_id"] for r in k.instruments.collect()] == ["ν.5090/2024"] and k.provisions.count() == 5
    assert sorted(r["action"] for r in k.amendments.collect()) == ["repeals", "replaces"]
    assert sorted(r["doc_id"] for r in k.review.collect()) == ["b", "c"] and k.delegations.count() == 0


def test_jobs(spark, tmp_path):
    from statuta.plans import jobs

    s = files.Store(spark, str(tmp_path / "store"))
    issues = spark.createDataFrame([("a", ISSUE), ("b", "τίποτα"), ("c", ISSUE)], "doc_id string, text string")
    states = {r["doc_id"]: (r["status"], r["confidence"]) for r in jobs.process(s, issues).collect()}
    assert states == {"a": ("done", 1.0), "b": ("review", None)}
    assert {n: s.count(n) for n in ("documents", "provisions", "amendments", "delegations", "articles")} == {"documents": 1, "provisions": 5, "amendments": 2, "delegations": 0, "articles": 3}
    jobs.process(s, issues)
    assert s.count("states") == 2 and s.count("provisions") == 5
    records, told = jobs.validate(issues.limit(2))
    assert told.first()["identified"] == 1 and records.count() == 1


def test_enrichment(spark):
    from statuta.operators import enrich

    p = spark.createDataFrame([("ν.1/2000", "ν.1/2000#αρ.1", 0, "article", "Το άρθρο 5 του ν. 2/2001 καταργείται", "2000-05-01"), ("ν.1/2000", "ν.1/2000#αρ.2", 1, "article", "Τίποτα", None)], "instrument_id string, canonical_id string, chunk_index int, chunk_type string, text string, fek_date string")
    answer = '{"amendments":[{"action":"Repeals","scope":"x","target_law_number":"2/2001","target_law_type":"pd","target_article_number":"5","target_case":"null"},{"action":"none"},{"action":"zz","target_law_number":"1/2000","target_article_number":"3","new_text":"α"}]}'
    e = enrich.amendments(p, lambda xs: [answer for _ in xs], "model").orderBy("target_id").collect()
    assert [(r["action"], r["scope"], r["target_id"], r["resolved"], r["ordinal"]) for r in e] == [("amends", "article", "ν.1/2000#αρ.3", True, 0), ("repeals", "article", "π.δ.2/2001#αρ.5", False, 0)]
    a = spark.createDataFrame([('{"type": "Νόμος", "number": 5}',), ('{"type": "Προεδρικό Διάταγμα", "number": 5}',), ("?",)], "x string").select(enrich.instrument_type(F.col("x")).alias("t")).collect()
    assert [r["t"] and tuple(r["t"]) for r in a] == [("NOMOS", 5), ("PD", None), None]
    rows = spark.createDataFrame([("a", None, ["k"], [], []), ("b", "s", ["k"], [], [])], "canonical_id string, chunk_summary string, keywords array<string>, domain_eurovoc array<string>, domain_dkn array<string>")
    told = spark.createDataFrame([("a", '{"summary": "σ", "dkn": ["ΕΝΕΡΓΕΙΑ", "άλλο"]}'), ("b", "broken")], "canonical_id string, answer string")
    got = {r["canonical_id"]: r for r in enrich.merge_facts(rows, told).collect()}
    assert (got["a"]["chunk_summary"], got["a"]["keywords"], got["a"]["domain_dkn"]) == ("σ", ["k", "άλλο"], ["ΕΝΕΡΓΕΙΑ"]) and got["b"]["chunk_summary"] == "s"
    t = spark.createDataFrame([("a", "| x | y |\n| 1 | 2 |"), ("b", "χωρίς")], "canonical_id string, text_in_force string")
    n = {r[0]: r[1] for r in enrich.narrate_tables(t, lambda xs: ["αφήγηση" for _ in xs]).collect()}
    assert n["a"].endswith("αφήγηση") and n["b"] == "χωρίς"
    v = enrich.embed(t.unionByName(spark.createDataFrame([("c", "νόμος " * 40), ("d", "")], t.schema)), size=32, budget=50).collect()
    assert sorted(r["canonical_id"] for r in v) == ["a", "b", "c", "d"] and all(abs(np.linalg.norm(r["vector"]) - 1) < 1e-5 for r in v if r["canonical_id"] != "d")
    assert [r["canonical_id"] for r in enrich.rerank(t, "q", lambda q, xs: [float(len(x)) for x in xs], "canonical_id", "text_in_force", 1).collect()] == ["a"]
    assert enrich.report(t, "canonical_id", ["canonical_id"], ["text_in_force"]).where("canonical_id = 'b'").first()["markdown"] == "## b\n- **canonical_id**: b\n\n```\nχωρίς\n```\n\n"
