"""Each stage of the pipeline against what its operator says of the stage's own input, and the whole of it."""

import os
import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from statuta.llm import decontamination, lines, near, packing, simhash, toxicity
from tests.llm import edge

SF = "/root/testdata/sf0.001"


def test_near_dedup_links_at_the_threshold_and_not_below(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    texts = []
    for changes in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14] * 6:
        w = [word() for _ in range(200)]
        for _ in range(3):
            x = list(w)
            for at in r.sample(range(0, 200, 5), changes):
                x[at] = word()
            texts.append(" ".join(x))
    common = [word() for _ in range(150)]
    texts += [" ".join(common + [word() for _ in range(n)]) for n in (10, 20, 30, 38, 40, 60, 90) for _ in range(4)]
    texts += ["", " ", None, "one two", "One  two", "one three", texts[5], texts[5].upper()]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[0]), (len(texts) + 5, texts[9]), (len(texts) + 5, texts[40])]
    known = [(i, t) for i, t in rows if i is not None]
    sets = [set(zip(*(w[k:] for k in range(5)))) if len(w := (t or "").lower().split()) >= 5 else {tuple(w)} - {()} for _, t in known]
    root = {i: i for i, _ in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, _) in enumerate(known):
        for m, (j, _) in enumerate(known[:k]):
            if sets[k] == sets[m] or 5 * len(sets[k] & sets[m]) >= 4 * len(sets[k] | sets[m]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(x["doc_id"] for x in corpus_pipeline.near_dedup(spark, df, SF).collect())
    assert kept == Counter([i for i, _ in rows if i is None] + [*{i for i, _ in rows if i is not None and find(i) == i}])
    assert corpus_pipeline.near_dedup(spark, df.limit(0), SF).count() == 0


def test_near_dedup_verifies_links_of_the_tries(spark, monkeypatch):
    """Without the exact way for the rest, the tries' links find near copies; loose links that aren't similar go."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    rows = []
    for k in range(20):
        w = [word() for _ in range(300)]
        rows += [(3 * k, " ".join(w)), (3 * k + 1, " ".join(w[:-1] + [word()])), (3 * k + 2, " ".join(w[:150]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {k for k in range(60) if k % 3 != 1}
    monkeypatch.setattr(near, "_pairs", lambda postings, t: postings.where("false").select(F.col("x.id").alias("x"), F.col("y.id").alias("y")))
    assert {x["doc_id"] for x in corpus_pipeline.near_dedup(spark, df, SF).collect()} == want
    every = {"words": 5, "similar": 0.8, "tables": 1, "budget": 24}
    assert {x["doc_id"] for x in simhash.keep_first(df, **every).collect()} >= want


def test_stages_take_every_awkward_row(spark, tmp_path):
    """Nulls, empty texts, repeated rows, clashing columns, an empty table: each stage runs, and keeps its columns."""
    columns = ["doc_id", "text", "lang", "source", "n_chars", "item_id", "toks", "line"]
    rows = [(r[0], r[1], r[2], None, len(r[1] or ""), "x", 1, "y") for r in edge.rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, item_id string, toks int, line string")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "packing" or docs.columns == columns and docs.count() > 20
        if name == "near_dedup":
            ids = Counter(r[0] for r in docs.select("doc_id").collect())
            assert all(n == 1 for i, n in ids.items() if i is not None)


def test_stages(spark, tmp_path):
    docs = before = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs
        ids = Counter(r[0] for r in docs.select("doc_id").collect())
        if name == "toxicity":
            model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
            assert ids == Counter(r[0] for r in toxicity.score(before, model).where("predicted = 0").collect())
        elif name == "line_dedup":
            gone = {r["doc_id"]: {int(x) for x in r["removed"].split(",") if x} for r in lines.summary(before).collect()}
            want = {}
            for r in before.collect():
                left = "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in gone[r["doc_id"]])
                if not gone[r["doc_id"]] or left.strip():
                    want[r["doc_id"]] = left
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
        elif name == "near_dedup":
            assert set(ids) == {r["doc_id"] for r in simhash.near_duplicates(before, **corpus_pipeline.NEAR).collect() if r["doc_id"] == r["component_id"]}
        elif name == "decontamination":
            leaked = {r["doc_id"] for r in decontamination.leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert set(ids) == {r["doc_id"] for r in before.collect()} - leaked
        if name != "packing":
            assert docs.columns == columns
    packed = kept["packing"].toPandas().sort_values(["sequence_id", "offset"])
    assert set(packed["doc_id"]) == {r["doc_id"] for r in kept["decontamination"].collect()}
    assert (packed["offset"] == packed.groupby("sequence_id")["length"].cumsum() - packed["length"]).all()
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect())) == Counter(map(tuple, kept["packing"].select("doc_id", "piece", "ids_crc32").collect()))
    left = [x for x in os.listdir(spark.conf.get("spark.checkpoint.dir")) if x.startswith("pipeline-")]
    assert all(os.listdir(f"{spark.conf.get('spark.checkpoint.dir')}/{x}") == ["3_decontamination"] for x in left) and left
    assert packing.pack(before.limit(0)).count() == 0


def test_line_dedup_stage_counts_every_text(spark, monkeypatch):
    """The stage's rarity order is of all lines of all documents."""
    rows = [(k, f"a{k} b{k} c{k}\nd{k} e{k} f{k} g{k} h{k} i{k}", "en", "s", 1) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    counted, count = [], lines.rarity
    monkeypatch.setattr(lines, "rarity", lambda rows: counted.append(rows.count()) or count(rows))
    assert corpus_pipeline.line_dedup(spark, df, "").count() == 40
    assert counted == [80]


def test_toxicity_stage_learns_from_every_labelled_row(spark, monkeypatch, tmp_path):
    """All labels outside the held-out third, whatever their number: there was a cap of 20,000."""
    n = 32_000
    docs = spark.range(n).selectExpr("id as doc_id", "concat('word ', id % 97, if(id % 10 = 0, ' vile', ' fine')) as text")
    docs.selectExpr("doc_id", "1 as quality", "int(doc_id % 10 = 0) as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    read, learn = [], toxicity.learn_lexicon
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda rows: read.append(rows.count()) or learn(rows))
    left = corpus_pipeline.without_toxic(spark, docs, str(tmp_path))
    assert read == [docs.where("crc32(cast(doc_id as string)) % 3 <> 1").count()] and read[0] > 20_000
    assert left.where("text like '%vile'").count() == 0 and left.count() == n - n // 10
