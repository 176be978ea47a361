"""Connected components by local contraction.

Each round gives every vertex a random priority, points it at the best vertex of its closed neighbourhood and
contracts the edges along these pointers. The expected number of vertices falls by a constant factor a round,
whatever the order of the ids, so long paths and large stars both take a logarithmic number of rounds. Degrees
never matter: neighbourhoods are reduced by a partial aggregation, not collected. When no more than CORE edges are left,
one task solves them, with the same result as further rounds.

Each round writes the vertices it removes once, as a layer of its own; labels are given back from the last layer to the
first, and no layer is written again.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evspark.runtime import checkpoint

#: Edges that one task solves: some tens of megabytes.
CORE = 50_000


def undirected(edges: DataFrame) -> DataFrame:
    """Distinct edges (u, v) with u < v, without loops and nulls."""
    return (
        edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )


def _union_find(batches):
    parent: dict = {}
    schema = None

    def root(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = p = parent[p]
            x = p
        return x

    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if schema is not None:
        moved = [(x, r) for x in list(parent) if (r := root(x)) != x]
        kind = schema.field(0).type
        columns = [pa.array([m[i] for m in moved], kind) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "parent"])


def solve(core: DataFrame) -> DataFrame:
    """Pointers (id, parent) of a core of at most CORE edges, each to the smallest id of its component."""
    kind = core.schema["u"].dataType.simpleString()
    return checkpoint(core.select("u", "v").coalesce(1).mapInArrow(_union_find, f"id {kind}, parent {kind}"))


def contract(edges: DataFrame, core: int = CORE) -> list[DataFrame]:
    """The layers of pointers (id, parent) that contract written edges until none is left; see ``restore``."""
    history: list[DataFrame] = []
    live, n, k = edges, edges.count(), 0
    while n > core:
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c, k=k: F.struct(F.xxhash64(F.lit(k), F.col(c)).alias("h"), F.col(c).alias("id"))
        best = both.groupBy(F.col("u").alias("id")).agg(F.min(rank("v")).alias("b"))
        pointers = checkpoint(best.select("id", F.least("b", rank("id")).getField("id").alias("parent")))
        moved = pointers.where(F.col("id") != F.col("parent"))
        # a vertex that another one points at still has an edge, to where it points itself
        history.append(checkpoint(moved.join(moved.select(F.col("parent").alias("id")).distinct(), "id", "left_anti")))
        pu = pointers.select(F.col("id").alias("u"), F.col("parent").alias("pu"))
        pv = pointers.select(F.col("id").alias("v"), F.col("parent").alias("pv"))
        live = checkpoint(
            undirected(live.join(pu, "u").join(pv, "v").select(F.col("pu").alias("u"), F.col("pv").alias("v")))
        )
        n, k = live.count(), k + 1
    return [*history, solve(live)] if n else history


def restore(history: list[DataFrame]) -> DataFrame:
    """(id, root) of every vertex of the layers and of the roots. A vertex is in one layer, its parent in a later one or a root."""
    done: list[DataFrame] = []
    for pointers in reversed(history):
        if done:
            known = reduce(DataFrame.unionByName, done).select(F.col("id").alias("parent"), "root")
            # both sides are bare shuffles: the children of a hot parent are a skewed partition, which is split
            done.append(checkpoint(pointers.join(known, "parent", "left").select("id", F.coalesce("root", "parent").alias("root"))))
        else:
            done.append(pointers.select("id", F.col("parent").alias("root")))
    labels = reduce(DataFrame.unionByName, done)
    return labels.unionByName(labels.select(F.col("root").alias("id"), "root").distinct())


def smallest(labels: DataFrame) -> DataFrame:
    """(id, group, n): the smallest id and the number of ids of each root."""
    first = checkpoint(labels.groupBy("root").agg(F.min("id").alias("group"), F.count("*").alias("n")))
    return labels.join(first, "root").select("id", "group", "n")


def components(edges: DataFrame, core: int = CORE) -> DataFrame:
    """(id, group) for every end of an edge; ``group`` is the smallest id of its component.

    ``edges`` has (u, v) of any one type. Loops and nulls link nothing; a vertex that has only loops gets no row;
    no edges give no rows. ``core`` edges at most are solved by one task.
    """
    links = checkpoint(undirected(edges))
    history = contract(links, core)
    if not history:
        return links.select(F.col("u").alias("id"), F.col("u").alias("group"))
    return smallest(restore(history)).select("id", "group")
