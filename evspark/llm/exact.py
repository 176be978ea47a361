"""Duplicates hidden by formatting differences (problem 6).

Method: progressive partition refinement in three levels, each of which looks only at rows that share their class with
another row; a row that is alone leaves.

1. Counts of digits and of some letters, taken from the texts as they stand: formatting changes none of them.
2. Lengths without formatting and the letter histogram; here texts are stripped, of the rows left only.
3. The whole keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.runtime import checkpoint, pairs_within, table

DOI = r"10\.\d{4,9}/"
#: White space, punctuation, controls and ASCII symbols: what formatting may change.
FORMATTING = r"[\s\p{Z}\p{P}\p{C}$+<=>^`|~]+"
CONTENT = FORMATTING.replace("[", "[^").removesuffix("+")
#: Members of a class that one task pairs with each other; larger classes are salted.
BLOCK = 500


def stripped(column: Column) -> Column:
    """Text without formatting and letter case. A sharp s is ss, which is how capitals have it, and letters with two
    small forms have one."""
    small = F.lower(F.regexp_replace(F.coalesce(column, F.lit("")), FORMATTING, ""))
    return F.replace(F.translate(small, "ςſı", "σsi"), F.lit("ß"), F.lit("ss"))


def title_and_doi(title: Column, doi: Column) -> tuple[Column, Column]:
    """The two texts, whichever field each stands in; the DOI without label or address."""
    t, d = F.coalesce(title, F.lit("")), F.coalesce(doi, F.lit(""))
    blank = F.regexp_replace(d, FORMATTING, "") == ""
    swapped = ~d.rlike(DOI) & (t.rlike(r"^.{0,60}?" + DOI + r"\S+\W*$") | ((F.regexp_replace(t, FORMATTING, "") == "") & ~blank))
    the_doi = F.when(swapped, t).otherwise(d)
    bare = F.when(the_doi.rlike(DOI), F.regexp_extract(the_doi, r"(?s)" + DOI + r".*", 0)).otherwise(the_doi)
    return F.when(swapped, d).otherwise(t), bare


def _counted(column: Column, letters: str) -> Column:
    return F.length(column) - F.length(F.translate(column, letters, ""))


def _parted(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The written rows whose class has several members, and those that are alone.

    The classes are counted before the shuffle and written, so that both sides of the join are bare shuffles, of which
    adaptive execution splits the partition of a class that holds much of the input.
    """
    n = checkpoint(rows.where(F.col(key).isNotNull()).groupBy(key).agg((F.count("*") > 1).alias("more")))
    several = rows.join(n.where("more"), key, "left_semi")
    return several, rows.join(n.where("more"), key, "left_anti")


def refine(records: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(record_id, key) of the rows that are in a class with another row up to the last level, with a hash of their whole
    texts, and the (record_id) of those that left, level by level.

    Null, empty and blank are the same missing value; a row with neither title nor DOI is in no class.
    """
    title, doi = title_and_doi(F.col("title"), F.col("doi"))
    raw = records.select("record_id", title.alias("t"), doi.alias("d"))
    # small and capital letters that no other letter becomes in small letters
    counts = [_counted(F.col(c), x) for c in "td" for x in (*"0123456789", "aA", "eE", "nN", "oO", "rR", "tT")]
    some = F.col("t").rlike(CONTENT) | F.col("d").rlike(CONTENT)
    first = checkpoint(raw.withColumn("k1", F.when(some, F.xxhash64(*counts))))
    several, alone = _parted(first, "k1")
    left = [alone.select("record_id")]
    texts = several.select("record_id", stripped(F.col("t")).alias("t"), stripped(F.col("d")).alias("d"))
    histogram = [_counted(F.col("t"), c) for c in "aeiostnrlcdmup"]
    # a chance collision of hashes only leaves a row for the next level
    second = checkpoint(texts.withColumn("k2", F.xxhash64(F.length("t"), F.length("d"), *histogram)))
    several, alone = _parted(second, "k2")
    left.append(alone.select("record_id"))
    return checkpoint(several.select("record_id", F.sha2(F.concat_ws("\x01", "t", "d"), 256).alias("key"))), left


def classes(records: DataFrame) -> DataFrame:
    """(record_id, copies): one row per set of copies, named by its smallest id, single rows included.

    ``copies`` counts rows, the row itself too. A row with neither title nor DOI is a set of its own.
    """
    likely, left = refine(records)
    out = likely.groupBy("key").agg(F.min("record_id").alias("record_id"), F.count("*").alias("copies")).select("record_id", "copies")
    for alone in left:
        out = out.unionByName(alone.select("record_id", F.lit(1).cast("long").alias("copies")))
    return out


def copy_pairs(records: DataFrame) -> DataFrame:
    """(record_id_a, record_id_b): every pair of copies, the smaller id first.

    The rows of a large class are dealt to blocks: each task pairs one block with the class, never a whole class
    with itself. Rows that share even the id are one id, which has no pair.
    """
    likely, _ = refine(records)
    return pairs_within(likely, ["key"], "record_id", BLOCK).select("record_id_a", "record_id_b").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_pairs(table(spark, sf_dir, "records"))


def p6_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of two or more copies with their number of rows."""
    return classes(table(spark, sf_dir, "records")).where("copies > 1")


_KEYS = r"""
k AS (
  SELECT record_id, coalesce(title, '') AS t, coalesce(doi, '') AS d FROM records),
s AS (
  SELECT record_id, t, d, NOT regexp_matches(d, '10\.\d{4,9}/') AND (regexp_matches(t, '^.{0,60}?10\.\d{4,9}/\S+\W*$')
    OR (regexp_replace(t, '[\s\p{Z}\p{P}\p{C}$+<=>^`|~]+', '', 'g') = '' AND regexp_replace(d, '[\s\p{Z}\p{P}\p{C}$+<=>^`|~]+', '', 'g') <> '')) AS sw FROM k),
w AS (SELECT record_id, CASE WHEN sw THEN d ELSE t END AS t, CASE WHEN sw THEN t ELSE d END AS d FROM s),
n AS (
  SELECT record_id, replace(lower((regexp_replace(t, '[\s\p{Z}\p{P}\p{C}$+<=>^`|~]+', '', 'g'))), 'ß', 'ss') AS t,
    replace(lower((regexp_replace(CASE WHEN regexp_matches(d, '10\.\d{4,9}/') THEN regexp_extract(d, '(?s)10\.\d{4,9}/.*') ELSE d END,
      '[\s\p{Z}\p{P}\p{C}$+<=>^`|~]+', '', 'g'))), 'ß', 'ss') AS d FROM w)
"""

ORACLE = {
    "p6_found": f"""WITH {_KEYS}
SELECT DISTINCT a.record_id AS record_id_a, b.record_id AS record_id_b FROM n a JOIN n b
ON a.t = b.t AND a.d = b.d AND a.record_id < b.record_id WHERE a.t <> '' OR a.d <> ''""",
    "p6_copies": f"""WITH {_KEYS}
SELECT min(record_id) AS record_id, count(*) AS copies FROM n WHERE t <> '' OR d <> '' GROUP BY t, d HAVING count(*) > 1""",
}
