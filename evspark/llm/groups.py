"""Consolidating pairwise matches into groups (problem 4).

Method: vertices of degree one are stripped and chains of degree-two vertices are compressed by list ranking. Each
round takes out an independent set of such vertices, chosen by random priorities: of two neighbours of degree two at most,
the one with the smaller priority may go. A leaf points at its neighbour; a vertex of a chain points at one neighbour,
and its two neighbours are linked. Rounds go on while they remove a good part of the vertices; what is left is the reduced
core, which is solved by local contraction, and by one task as soon as it is small. Then the labels are given back to the
removed vertices, last removed first. A match graph is mostly pairs, stars and short chains, so the core is a small part.

Every step is an aggregation or an equi-join over links or vertices. Neighbourhoods are never collected: a vertex
of degree one or two is described by its count, smallest and largest neighbour. A round takes three shuffles, and each
removed vertex is written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.operators.components import CORE, contract, restore, smallest, undirected
from evspark.runtime import blank_to_null, checkpoint, table

#: Stripping goes on while a round removes at least this part of the vertices.
LEAST_PART = 0.1


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("u"), F.greatest(x, y).alias("v")]


def _reduced(links: DataFrame, k: int) -> tuple[DataFrame, DataFrame, int]:
    """One round: the vertices taken out (id, parent), the other links, and how many vertices there were."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    vertices = checkpoint(both.groupBy(F.col("u").alias("id")).agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")))
    rank = F.struct(F.xxhash64(F.lit(k), F.col("id")).alias("h"), F.col("id").alias("x"))
    thin = vertices.where("n <= 2").select("id", "n", "a", "b", rank.alias("rank"))
    # each tells its neighbours its priority, of which the least is kept: a hub hears any number of them at no cost
    told = thin.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("id"), F.col("rank").alias("heard"))
    met = thin.withColumn("own", F.struct("rank", "n", "a", "b")).select("id", "own").unionByName(told, allowMissingColumns=True)
    free = met.groupBy("id").agg(F.max("own").alias("own"), F.min("heard").alias("heard"))
    gone = checkpoint(free.where("own IS NOT NULL AND (heard IS NULL OR own.rank < heard)").select("id", "own.n", "own.a", "own.b"))
    cut = gone.select(*_pair("id", "a")).unionByName(gone.where("n = 2").select(*_pair("id", "b"))).withColumn("old", F.lit(1))
    new = gone.where("n = 2").select(*_pair("a", "b")).withColumn("old", F.lit(0))
    kept = links.withColumn("old", F.lit(0)).unionByName(cut).unionByName(new).groupBy("u", "v").agg(F.max("old").alias("old"))
    return gone.select("id", F.col("a").alias("parent")), checkpoint(kept.where("old = 0").select("u", "v")), vertices.count()


def labels(pairs: DataFrame, core: int = CORE) -> DataFrame | None:
    """(id, root) for every end of a link (u, v); None if nothing links two different ids. A core of at most ``core``
    links is left to one task; at least one round comes before."""
    live = checkpoint(undirected(pairs))
    history: list[DataFrame] = []
    more = not live.isEmpty()
    while more:
        gone, live, before = _reduced(live, len(history))
        history.append(gone)
        more = live.count() > core and gone.count() >= LEAST_PART * before
    history += contract(live, core)
    return restore(history) if history else None


def consolidate(pairs: DataFrame) -> DataFrame:
    """(id, group, n): for every id linked to another one, directly or over any number of links, the smallest id
    and the size of its group.

    ``pairs`` has (u, v). Nulls and loops link nothing; repeated and reversed pairs count once; an empty table gives
    an empty one. Other columns are ignored.
    """
    found = labels(pairs.select("u", "v"))
    if found is None:
        return pairs.select(F.col("u").alias("id"), F.col("u").alias("group"), F.lit(0).cast("long").alias("n")).where(F.lit(False))
    return smallest(found)


def match_links(review_pairs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Links (u, v) of decided pairs, matches and group ids, with trimmed ids."""
    ids = lambda df, a, b: df.select(blank_to_null(F.col(a)).alias("u"), blank_to_null(F.col(b)).alias("v"))
    decided = F.lower(blank_to_null(F.col("decision"))) == "duplicate"
    return (
        ids(review_pairs.where(decided), "record_id_a", "record_id_b")
        .unionByName(ids(ledger, "record_id", "matched_to"))
        .unionByName(ids(ledger, "record_id", "group_id"))
    )


def record_groups(review_pairs: DataFrame, ledger: DataFrame) -> DataFrame:
    """(record_id, group_first): ledger records that share a group with another ledger record.

    Ids without a ledger row link, but are neither listed nor counted. Blank ids are no ids.
    """
    found = labels(match_links(review_pairs, ledger))
    ids = ledger.select(blank_to_null(F.col("record_id")).alias("id")).where("id IS NOT NULL").distinct()
    if found is None:
        return ids.select(F.col("id").alias("record_id"), F.col("id").alias("group_first")).where(F.lit(False))
    own = found.join(ids, "id", "left_semi")
    size = checkpoint(own.groupBy("root").agg(F.min("id").alias("group_first"), F.count("*").alias("n")).where("n > 1"))
    # written, so that the join has two bare shuffles and a hot group is split
    return own.join(size, "root").select(F.col("id").alias("record_id"), "group_first")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_groups(table(spark, sf_dir, "review_pairs"), table(spark, sf_dir, "ledger"))


def p4_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many groups there are of each size, ids without a ledger row included."""
    groups = consolidate(match_links(table(spark, sf_dir, "review_pairs"), table(spark, sf_dir, "ledger")))
    return groups.where(F.col("id") == F.col("group")).groupBy("n").agg(F.count("*").alias("n_groups"))


ORACLE = {
    "p4_found": """
WITH RECURSIVE t AS (
  SELECT trim(record_id) r, nullif(trim(matched_to), '') m, nullif(trim(group_id), '') g FROM ledger),
l AS (
  SELECT trim(record_id_a) u, trim(record_id_b) v FROM review_pairs WHERE lower(trim(decision)) = 'duplicate'
  UNION SELECT r, m FROM t WHERE m IS NOT NULL UNION SELECT r, g FROM t WHERE g IS NOT NULL),
e AS (SELECT u, v FROM l WHERE u <> v AND u <> '' AND v <> '' UNION SELECT v, u FROM l WHERE u <> v AND u <> '' AND v <> ''),
walk AS (SELECT u AS id, u AS seen FROM e UNION SELECT w.id, e.v FROM walk w JOIN e ON w.seen = e.u),
root AS (SELECT id, min(seen) AS root FROM walk GROUP BY id),
own AS (SELECT id, root FROM root WHERE id IN (SELECT r FROM t)),
first AS (SELECT root, min(id) AS group_first FROM own GROUP BY root HAVING count(*) > 1)
SELECT id AS record_id, group_first FROM own JOIN first USING (root)""",
    "p4_group_sizes": """
WITH RECURSIVE t AS (
  SELECT trim(record_id) r, nullif(trim(matched_to), '') m, nullif(trim(group_id), '') g FROM ledger),
l AS (
  SELECT trim(record_id_a) u, trim(record_id_b) v FROM review_pairs WHERE lower(trim(decision)) = 'duplicate'
  UNION SELECT r, m FROM t WHERE m IS NOT NULL UNION SELECT r, g FROM t WHERE g IS NOT NULL),
e AS (SELECT u, v FROM l WHERE u <> v AND u <> '' AND v <> '' UNION SELECT v, u FROM l WHERE u <> v AND u <> '' AND v <> ''),
walk AS (SELECT u AS id, u AS seen FROM e UNION SELECT w.id, e.v FROM walk w JOIN e ON w.seen = e.u),
root AS (SELECT id, min(seen) AS root FROM walk GROUP BY id),
size AS (SELECT root, count(*) AS n FROM root GROUP BY root)
SELECT n, count(*) AS n_groups FROM size GROUP BY n""",
}
