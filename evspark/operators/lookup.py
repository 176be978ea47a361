"""Lookups by priority, versioned caches, same-study pairs, grouping by study (JN-21 to JN-23, DD-8, DD-9, AGG-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evspark.functions.text import norm_text
from evspark.runtime import pairs_within


def first_by(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order, by an aggregation that combines before the shuffle."""
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), place).alias("_best"))
    return best.select(*keys, "_best.*").select(*rows.columns)


def priority_lookup(rows: DataFrame, levels: list[tuple[DataFrame, list[str]]], value: str) -> DataFrame:
    """Rows with ``value`` and ``level`` of the first level that knows their keys; NULL and NULL if none does.

    ``levels`` lists tables with their join keys, at most one row a key. Each level is one equi-join; a table with
    several rows of a key has to be reduced by ``first_by`` before.
    """
    out = rows
    for i, (table, keys) in enumerate(levels):
        out = out.join(table.select(*keys, F.col(value).alias(f"_v{i}")), keys, "left")
    known = [F.when(F.col(f"_v{i}").isNotNull(), F.lit(i + 1)) for i in range(len(levels))]
    out = out.withColumns({value: F.coalesce(*[F.col(f"_v{i}") for i in range(len(levels))]), "level": F.coalesce(*known)})
    return out.drop(*[f"_v{i}" for i in range(len(levels))])


def cached_attributes(rows: DataFrame, cache: DataFrame, version: str) -> DataFrame:
    """Rows with the attributes that one version of a cache (entity, cache_version, ...) has for their entity."""
    return rows.join(cache.where(F.col("cache_version") == version).drop("cache_version"), "entity", "left")


def exact_duplicates(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Rows with ``duplicate_of``: the first row's order of the same key, NULL for that row itself (DD-8)."""
    first = rows.groupBy(key).agg(F.min(order).alias("_first"))
    return rows.join(first, key).withColumn("duplicate_of", F.when(F.col(order) != F.col("_first"), F.col("_first"))).drop("_first")


def representatives(reports: DataFrame) -> DataFrame:
    """Reports (Study_ID, source_id, version, ...) with ``representative``: a journal version first, then the largest id (DD-9)."""
    w = Window.partitionBy("Study_ID").orderBy(F.desc(F.coalesce(F.col("version") == "journal", F.lit(False))), F.desc("source_id"))
    return reports.withColumn("representative", F.row_number().over(w) == 1)


def same_study_pairs(reports: DataFrame, least_authors: float = 0.5, least_title: float = 0.3) -> DataFrame:
    """(a, b, shared_authors, title_overlap, relative_length): pairs of reports that may be of one study (JN-22).

    ``reports`` has source_id, authors ARRAY, title and length. Pairs meet through a shared author, so the work is that
    of the authors' own reports; the shares of authors and of title words decide.
    """
    own = reports.select(
        "source_id", F.array_distinct(F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))).alias("authors"),
        F.array_distinct(F.split(norm_text(F.col("title")), " ")).alias("words"), "length",
    )
    by = own.select("source_id", F.explode("authors").alias("author")).where("author <> ''")
    met = pairs_within(by, ["author"], "source_id").groupBy(F.col("source_id_a").alias("a"), F.col("source_id_b").alias("b")).agg(F.count("*").alias("n"))
    side = lambda s: own.select(F.col("source_id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in own.columns[1:]])
    both = met.join(side("a"), "a").join(side("b"), "b")
    authors = F.col("n") / F.least(F.size("a_authors"), F.size("b_authors"))
    title = F.size(F.array_intersect("a_words", "b_words")) / F.size(F.array_union("a_words", "b_words"))
    length = F.try_divide(F.least("a_length", "b_length"), F.greatest("a_length", "b_length"))
    out = both.select("a", "b", authors.alias("shared_authors"), title.alias("title_overlap"), length.alias("relative_length"))
    return out.where((F.col("shared_authors") >= least_authors) & (F.col("title_overlap") >= least_title))


def by_unit(rows: DataFrame, unit: list[str], values: list[str]) -> DataFrame:
    """Means of rows of one independent unit, before anything is coded from them (AGG-16)."""
    return rows.groupBy(*unit).agg(F.count("*").alias("n_rows"), *[F.avg(v).alias(v) for v in values])
