"""The path of records through a synthesis, with its balances (AGG-7): search, linkage, screening, audit, grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evspark.operators import audit, lookup, screening


def flow(records: DataFrame, first_phase: list[screening.Criterion], full_texts: DataFrame, rules: DataFrame, holds, votes: DataFrame, human: DataFrame) -> dict[str, DataFrame]:
    """Tables of each step.

    ``records`` has record_id, source_id, source_key, title, abstract and ord; ``full_texts`` source_id and what
    ``holds``, a column over them and the rule versions, looks at; ``rules`` has version and what ``holds`` looks at.
    A confirmed miss makes the last version count, which has to include it.
    """
    marked = lookup.exact_duplicates(records, "source_key", "ord")
    unique = marked.where("duplicate_of IS NULL").drop("duplicate_of")
    decided = screening.screen(unique, first_phase, "ta", "1")
    candidates = unique.join(decided.where("decision = 'keep'").select("record_id"), "record_id", "left_semi").join(full_texts, "source_id")
    screened = audit.rule_versions(candidates, rules, holds)
    routed = audit.routed_votes(votes)
    final = audit.confirmed(routed, human)
    return {"duplicates": marked.where("duplicate_of IS NOT NULL"), "unique": unique, "first_phase": decided, "screened": screened, "audit": routed, "final": final}


def flow_counts(tables: dict[str, DataFrame], version: str) -> DataFrame:
    """One row of counts and whether they balance."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    own = tables["screened"].where(F.col("version") == version)
    parts = [
        n(tables["duplicates"], "duplicates"), n(tables["unique"], "screened_records"), n(tables["first_phase"].where("decision = 'exclude'"), "first_phase_excluded"),
        n(own, "full_texts_assessed"), n(own.where("NOT included"), "full_text_excluded"), n(own.where("included"), "included_reports"),
        n(tables["final"].where("final = 'include'"), "confirmed_misses"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # rows of one
    c = F.col
    balance = (c("screened_records") == c("first_phase_excluded") + c("full_texts_assessed")) & (c("full_texts_assessed") == c("full_text_excluded") + c("included_reports"))
    return out.withColumn("search_records", c("duplicates") + c("screened_records")).withColumn("balanced", balance)
