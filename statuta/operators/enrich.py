"""What models answer, joined to the tables: edits, types, summaries, keywords, narrations, vectors, reports.

The models themselves are providers (``sources.providers``); here are the columns that ask them and that
read their answers, so the same runs with a stand-in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions import keys
from statuta.functions import text as txt
from statuta.functions.tables import tables_json
from statuta.operators import chunks, search
from statuta.operators.classify import MORE_VOLUMES, VOLUMES, plain_fold
from statuta.sources.providers import ACTIONS, SCOPES, ask, hashed_embedding, lenient_json, nothing

# Stems by which a provision may amend anything, and labels of instrument types.
STEMS = "αντικαθίστ προστίθ καταργ τροποποι διαγράφ αναριθμ διαμορφών αντικαταστ".split()
LABELS = {
    "ΝΟΜΟΣ": "NOMOS", "ΠΡΟΕΔΡΙΚΟ ΔΙΑΤΑΓΜΑ": "PD", "ΠΡΑΞΗ ΝΟΜΟΘΕΤΙΚΟΥ ΠΕΡΙΕΧΟΜΕΝΟΥ": "PNP", "ΨΗΦΙΣΜΑ": "PSIFISMA", "ΑΝΑΓΚΑΣΤΙΚΟΣ ΝΟΜΟΣ": "AN",
    "ΝΟΜΟΘΕΤΙΚΟ ΔΙΑΤΑΓΜΑ": "ND", "ΚΑΝΟΝΙΣΜΟΣ ΒΟΥΛΗΣ": "KAN_VOULIS", "ΚΑΝΟΝΙΣΤΙΚΗ ΑΠΟΦΑΣΗ": "KAN_APOFASI", "ΑΠΟΦΑΣΗ ΔΙΟΙΚΗΤΗ": "APOFASI_DIOIKITI",
    "ΑΠΟΦΑΣΗ ΠΕΡΙΦΕΡΕΙΑΡΧΗ": "APOFASI_PERIF", "ΑΠΟΦΑΣΗ ΝΠΔΔ": "APOFASI_NPDD", "ΥΠΟΥΡΓΙΚΗ ΑΠΟΦΑΣΗ": "YA", "ΚΟΙΝΗ ΥΠΟΥΡΓΙΚΗ ΑΠΟΦΑΣΗ": "KYA", "ΠΡΑΞΗ ΥΠΟΥΡΓΙΚΟΥ ΣΥΜΒΟΥΛΙΟΥ": "PYS",
}
NUMBERED = ["NOMOS", "AN", "ND"]
HEAD = 2500
NARRATION = "[Πίνακας — αφήγηση περιεχομένου]"
_EDITS = "amendments array<struct<action:string,scope:string,target_law_number:string,target_law_type:string,target_article_number:string,target_paragraph:string,target_case:string,new_text:string,position:string>>"
_FACTS = "summary string, keywords array<string>, eurovoc array<string>, dkn array<string>"


def may_amend(text: Column) -> Column:
    out = F.lit(False)
    for s in STEMS:
        out = out | F.coalesce(text, F.lit("")).contains(s)
    return out


def amendments(provisions: DataFrame, complete: Callable[[list[str]], list[str]], method: str, rate: float | None = None) -> DataFrame:
    """Edges that a model finds in provisions (instrument_id, canonical_id, chunk_index, chunk_type, text, fek_date); not cleaned yet.

    Only provisions with a verb of amendment are asked about. An answer that names neither an article nor
    a text is dropped; a target that is the own law is in-law, and only those count as resolved. An edge's
    ordinal counts from 0 within its instrument's target.
    """
    asked = provisions.where((F.col("chunk_type") != "annex") & may_amend(F.col("text")))
    answers = ask(asked, "canonical_id", "text", complete, "answer", "string", rate)
    p = asked.select("instrument_id", "canonical_id", "chunk_index", "fek_date").join(answers.select("canonical_id", "answer"), "canonical_id")
    e = p.withColumn("a", lenient_json(F.col("answer"), _EDITS)).select("*", F.posexplode("a.amendments").alias("seq", "x"))
    field = lambda c: nothing(F.col(f"x.{c}"))
    named = field("target_law_number")
    law = F.when(named == keys.law_number(F.col("instrument_id")), "").otherwise(named)
    article, body = field("target_article_number"), F.trim(F.coalesce("x.new_text", F.lit("")))
    number, year = F.regexp_extract(law, r"^(\d+)/(\d+)$", 1), F.regexp_extract(law, r"^(\d+)/(\d+)$", 2)
    decree = F.lower(F.trim(F.coalesce("x.target_law_type", F.lit("")))).isin("pd", "π.δ.", "πδ")
    iid = F.when(law == "", F.col("instrument_id")).when(number == "", F.concat(F.lit("ν."), law)).otherwise(keys.instrument_id(F.when(decree, "PD").otherwise("NOMOS"), number.cast("int"), year.cast("int")))
    target = F.when(article == "", "").otherwise(keys.provision_id(iid, article, field("target_paragraph"), field("target_case")))
    action, scope = F.lower(F.trim(F.coalesce("x.action", F.lit("")))), F.lower(F.trim(F.coalesce("x.scope", F.lit(""))))
    e = e.where((article != "") | (body != "")).select(
        "instrument_id", F.col("canonical_id").alias("source_id"), "chunk_index", "seq", F.when(action.isin(*ACTIONS, "none"), action).otherwise("amends").alias("action"),
        F.when(scope.isin(*SCOPES), scope).otherwise("article").alias("scope"), target.alias("target_id"), F.nullif(body, F.lit("")).alias("text"),
        F.nullif(F.col("fek_date"), F.lit("")).alias("effective_date"), (law == "").alias("resolved"), F.lit(method).alias("extraction_method"),
    )
    w = Window.partitionBy("instrument_id", "target_id").orderBy("chunk_index", "seq")
    return e.withColumn("ordinal", F.row_number().over(w) - 1).drop("chunk_index", "seq")


def instrument_type(answer: Column) -> Column:
    """struct<instrument_type, number> of a model's answer, null if it names no known label; only some types keep a number."""
    a = lenient_json(answer, "type string, number string")
    folded, kind = txt.fold(F.trim(F.coalesce(a["type"], F.lit("")))), F
    for label, code in LABELS.items():
        kind = kind.when(folded == plain_fold(label), code)
    kind = kind.otherwise(None)
    number = F.when(kind.isin(*NUMBERED), a["number"].try_cast("int"))
    return F.when(kind.isNotNull(), F.struct(kind.alias("instrument_type"), number.alias("number")))


def merge_facts(provisions: DataFrame, answers: DataFrame) -> DataFrame:
    """Provisions (canonical_id, chunk_summary, keywords, domain_eurovoc, domain_dkn) with a model's answers (canonical_id, answer).

    Only volumes of the subject index enter it; other subjects become keywords. An answer that can't be read changes nothing.
    """
    volumes = F.array(*map(F.lit, sorted({*VOLUMES.values(), *(v for v, _ in MORE_VOLUMES)})))
    x = provisions.join(answers.select("canonical_id", lenient_json(F.col("answer"), _FACTS).alias("__a")), "canonical_id", "left")
    list_ = lambda c: F.coalesce(f"__a.{c}", F.array().cast("array<string>"))
    subjects = F.filter(list_("dkn"), lambda d: ~F.array_contains(volumes, d))
    words = F.when(F.size(list_("keywords")) > 0, list_("keywords")).otherwise(F.col("keywords"))
    return x.withColumns({
        "chunk_summary": F.coalesce("__a.summary", "chunk_summary"),
        "keywords": F.array_distinct(F.concat(words, subjects)),
        "domain_eurovoc": F.array_distinct(F.concat("domain_eurovoc", list_("eurovoc"))),
        "domain_dkn": F.array_distinct(F.concat("domain_dkn", F.filter(list_("dkn"), lambda d: F.array_contains(volumes, d)))),
    }).drop("__a")


def narrate_tables(provisions: DataFrame, complete: Callable[[list[str]], list[str]], text: str = "text_in_force", rate: float | None = None) -> DataFrame:
    """Provisions whose text holds tables get a narration of them below it, and the columns that follow from the text anew."""
    p = provisions.withColumn("__t", tables_json(F.col(text)))
    told = ask(p.where(F.col("__t").isNotNull()), "canonical_id", "__t", complete, "__n", "string", rate).select("canonical_id", F.trim("__n").alias("__n"))
    p = p.join(told, "canonical_id", "left")
    new = (F.coalesce("__n", F.lit("")) != "") & ~F.col(text).contains(F.col("__n"))
    body = F.when(new, F.concat(F.col(text), F.lit(f"\n\n{NARRATION}\n"), F.col("__n"))).otherwise(F.col(text))
    p = p.withColumn("__b", body).drop(text).withColumnRenamed("__b", text)
    again = {"text_normalized": txt.fold(F.col(text)), "text_stemmed": txt.stem(F.col(text)), "content_hash": F.sha2(text, 256)}
    return p.withColumns({c: e for c, e in again.items() if c in provisions.columns}).select(*provisions.columns)


def embed(provisions: DataFrame, provider: Callable[[list[str]], list[list[float]]] | None = None, size: int = 1024, budget: int = 14_400, text: str = "text_in_force") -> DataFrame:
    """canonical_id, vector: one unit vector a chunk; blank chunks count as a placeholder, oversize ones are split and their vectors pooled.

    Without a provider vectors are hashed stems.
    """
    p = provisions.select("canonical_id", F.when(txt.strip(F.coalesce(text, F.lit(""))) == "", "—").otherwise(F.col(text)).alias("t"))
    parts = p.select("canonical_id", F.posexplode(chunks.split_oversized(F.col("t"), budget)).alias("part", "t")).withColumn("key", F.concat_ws("@", "canonical_id", F.col("part").cast("string")))
    if provider is None:
        made = parts.select("canonical_id", hashed_embedding(F.col("t"), size).alias("vector"))
    else:
        made = parts.select("canonical_id", "key").join(ask(parts, "key", "t", provider, "vector", "array<float>").select("key", "vector"), "key").select("canonical_id", "vector")
    one = made.groupBy("canonical_id").agg(F.count("*").alias("n"), F.first("vector").alias("vector"))
    pooled = search.pool(made.join(one.where("n > 1"), "canonical_id", "left_semi"), "canonical_id", "vector", 9)
    pooled = pooled.groupBy("canonical_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda v: v["value"].cast("float")).alias("vector"))
    return one.where("n = 1").select("canonical_id", "vector").unionByName(pooled)


def rerank(candidates: DataFrame, query: str, scorer: Callable[[str, list[str]], list[float]], id_col: str, text_col: str, k: int) -> DataFrame:
    """The k candidates (a bounded list) of highest score by a pairwise scorer."""
    kind = dict(candidates.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], "score": scorer(query, b[text_col].tolist())})

    return candidates.select(id_col, text_col).mapInPandas(run, f"{id_col} {kind}, score double").orderBy(F.col("score").desc(), id_col).limit(k)


def report(rows: DataFrame, id_col: str, fields: list[str], texts: list[str]) -> DataFrame:
    """id, markdown: each row as a section with its fields as a list and its texts as blocks; empty ones are left out."""
    kinds = dict(rows.dtypes)
    value = lambda f: F.array_join(F.col(f).cast("array<string>"), ", ") if kinds[f].startswith("array") else F.col(f).cast("string")
    items = [F.when(F.coalesce(value(f), F.lit("")) != "", F.concat(F.lit(f"- **{f}**: "), value(f), F.lit("\n"))) for f in fields]
    blocks = [F.when(F.coalesce(F.col(t), F.lit("")) != "", F.concat(F.lit("\n```\n"), F.col(t), F.lit("\n```\n"))) for t in texts]
    return rows.select(F.col(id_col), F.concat_ws("", F.concat(F.lit("## "), F.col(id_col).cast("string"), F.lit("\n")), *items, *blocks, F.lit("\n")).alias("markdown"))


def gold_key(law: Column, article: Column, action: Column) -> Column:
    """The key by which predicted edges are held against gold ones: digits of the law, article, action."""
    return F.struct(F.regexp_extract(law, r"(\d+/\d{4})", 1).alias("law"), F.coalesce(article, F.lit("")).alias("article"), F.lower(action).alias("action"))


def predicted_edges(edges: DataFrame) -> DataFrame:
    """source law, target law, article, action of edges whose target is a law."""
    t = edges.where(F.col("target_id").startswith("ν."))
    return t.select(F.col("instrument_id").alias("source_law"), keys.law_number(keys.law_of(F.col("target_id"))).alias("target_law"), keys.article_number(F.col("target_id")).alias("target_article"), "action").distinct()
