"""The whole way from texts of issues to the tables of the store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.functions import text as txt
from statuta.operators import classify, edges, identify, parse


@dataclass
class Knowledge:
    """What issues hold: acts, those of them that are known (instruments), provisions (in force), amendments, delegations, and the issues that go to review."""

    acts: DataFrame
    instruments: DataFrame
    provisions: DataFrame
    amendments: DataFrame
    delegations: DataFrame
    review: DataFrame


def run(issues: DataFrame) -> Knowledge:
    """Issues (doc_id, text) normalised, identified, split, segmented, mined, consolidated and classified."""
    clean = issues.select("doc_id", txt.strip_furniture(txt.mixed_script(txt.display(F.coalesce("text", F.lit(""))))).alias("text"), identify.masthead(F.col("text")).alias("masthead"))
    acts = parse.identify(parse.split_acts(clean), clean)
    known = acts.where("instrument_id is not null")
    review = clean.select("doc_id").join(known.select("doc_id"), "doc_id", "left_anti")
    found = parse.segment(known)
    links = edges.clean(parse.amendments(found), own="instrument_id")
    force = edges.consolidate(found.select("canonical_id", "text"), links)
    found = found.join(force.drop("text"), "canonical_id").withColumn("cites", edges.eu_references(F.col("text_in_force")))
    # what is searched and compared is the text in force
    found = found.withColumns({"text_normalized": txt.fold(F.col("text_in_force")), "text_stemmed": txt.stem(F.col("text_in_force")), "content_hash": F.sha2("text_in_force", 256)})
    found = found.join(known.select("instrument_id", "title"), "instrument_id", "left")
    found = found.withColumn("legal_domain", classify.domains(F.col("text_in_force"), F.col("title"))).withColumn("domain_dkn", classify.volumes(F.col("text_in_force"), F.col("title"))).withColumn("language", txt.language(F.col("text_in_force"))).drop("title")
    categories = classify.document_categories(known, found)
    return Knowledge(acts, known.join(categories, "instrument_id", "left"), found, links, parse.delegations(known), review)
