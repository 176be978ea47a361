"""Quotations checked against their sources (FLT-15, JN-17, FN-22), headers of reports (SRC-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evspark.functions.text import quote_share


def source_lines(sources: DataFrame) -> DataFrame:
    """(source_id, line, text) with lines from 1."""
    cut = F.split(F.regexp_replace("text", r"\r\n?", "\n"), "\n")
    return sources.select("source_id", F.posexplode(cut).alias("line", "text")).withColumn("line", (F.col("line") + 1).cast("long"))


def check_quotes(quotes: DataFrame, sources: DataFrame) -> DataFrame:
    """Quotes (source_id, line, quote) with ``problem``: unknown source, empty quote, line out of range, or not there.

    The lines of a source are not exploded: a quote picks its own.
    """
    own = sources.select("source_id", F.split(F.regexp_replace("text", r"\r\n?", "\n"), "\n").alias("_lines"))
    out = quotes.join(own, "source_id", "left")
    line = F.try_element_at("_lines", F.when(F.col("line") >= 1, F.col("line").cast("int")).otherwise(F.lit(2147483647)))
    problem = (
        F.when(F.col("_lines").isNull(), "unknown source").when(F.coalesce("quote", F.lit("")) == "", "empty quote")
        .when(line.isNull(), "line out of range").when(~F.contains(line, F.col("quote")), "not on this line")
    )
    return out.withColumn("problem", problem).drop("_lines")


def locate_quotes(quotes: DataFrame, sources: DataFrame, share: float = 0.5) -> DataFrame:
    """Quotes with the part of their four-word runs that the source has, and whether that is enough."""
    out = quotes.join(sources.select("source_id", F.col("text").alias("_text")), "source_id", "left")
    return out.withColumn("share", quote_share(F.col("quote"), F.col("_text"))).withColumn("found", F.col("share") >= share).drop("_text")


def headers(sources: DataFrame, keys: list[str]) -> DataFrame:
    """(source_id, headers, problem): the ``Key: value`` lines of a report for these keys, each of which it has once."""
    names = "|".join(keys)
    lines = F.filter(F.split(F.regexp_replace("text", r"\r\n?", "\n"), "\n"), lambda x: x.rlike(f"^(?:{names}):"))
    pairs = F.transform(lines, lambda x: F.struct(F.substring_index(x, ":", 1).alias("key"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))
    out = sources.select("source_id", pairs.alias("p"))
    found = F.array_distinct(F.transform("p", lambda x: x["key"]))
    problem = F.when(F.size("p") > F.size(found), "repeated header").when(F.size(found) < len(keys), "missing header")
    return out.select("source_id", F.when(problem.isNull(), F.map_from_entries("p")).alias("headers"), problem.alias("problem"))
