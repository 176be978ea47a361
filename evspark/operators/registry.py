"""Stable row ids for identities (section 2.13): versioned, never reused, allocated in request order (WIN-8, JN-14).

A registry is a table (row_uid, identity MAP<STRING,STRING>, status). New versions are new tables; allocation numbers
only the identities that are new, by sorted ranges.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evspark.runtime import numbered

NAMESPACE = r"[A-Z][A-Z0-9-]{0,31}"


def identity_key(identity: Column) -> Column:
    """One text for an identity, whatever the order of its fields: exact text, no trimming or folding."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(identity))))


def _number(uid: Column) -> Column:
    return F.regexp_extract(uid, r"-R(\d{6,})$", 1).try_cast("long")


def problems(registry: DataFrame, fields: list[str], namespace: str, next_id: int) -> DataFrame:
    """(row_uid, problem): what makes a registry invalid; has to be empty."""
    if not re.fullmatch(NAMESPACE, namespace):
        raise ValueError("the namespace has to be capitals, digits and hyphens after a capital")
    if not fields or len(set(fields)) != len(fields):
        raise ValueError("identity fields have to be unique")
    rows = registry.withColumns({"key": identity_key(F.col("identity")), "n": _number(F.col("row_uid"))})
    values = F.map_values("identity")
    wrong = (
        F.when(~F.coalesce(F.col("row_uid").rlike(f"^{namespace}-R[0-9]{{6,}}$"), F.lit(False)) | (F.col("n") < 1), "malformed id")
        .when(~F.col("status").isin("active", "retired"), "unknown status")
        .when(F.array_sort(F.map_keys("identity")) != F.array(*[F.lit(f) for f in sorted(fields)]), "other identity fields")
        .when(F.exists(values, lambda v: v.isNull() | (F.trim(v) == "") | (F.trim(v) != v)), "blank or padded identity")
        .when(F.col("n") >= next_id, "id not below the counter")
    )
    single = rows.withColumn("problem", wrong).where("problem IS NOT NULL").select("row_uid", "problem")
    twice = lambda c, p: rows.groupBy(c).agg(F.max("row_uid").alias("uid"), F.count("*").alias("k")).where("k > 1").select(F.col("uid").alias("row_uid"), F.lit(p).alias("problem"))
    return single.unionByName(twice("row_uid", "id given twice")).unionByName(twice("key", "identity given twice"))


def next_id(registry: DataFrame) -> int:
    return (registry.agg(F.max(_number(F.col("row_uid")))).first()[0] or 0) + 1


def lookup(rows: DataFrame, registry: DataFrame, fields: list[str]) -> DataFrame:
    """Rows with their row_uid, and ``problem`` where the identity is unknown or retired."""
    own = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))])
    entries = registry.select(identity_key(F.col("identity")).alias("_key"), "row_uid", F.col("status").alias("_status"))
    out = rows.withColumn("_key", identity_key(own)).join(entries, "_key", "left")
    problem = F.when(F.col("row_uid").isNull(), "unregistered").when(F.col("_status") != "active", "retired")
    return out.withColumn("problem", problem).drop("_key", "_status")


def request_problems(requested: DataFrame, registry: DataFrame, fields: list[str]) -> DataFrame:
    """(key, problem): identities requested twice or retired; has to be empty."""
    own = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))])
    keys = requested.select(identity_key(own).alias("key"))
    gone = registry.where("status = 'retired'").select(identity_key(F.col("identity")).alias("key"))
    twice = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit("requested twice").alias("problem"))
    return twice.unionByName(keys.join(gone, "key", "left_semi").distinct().withColumn("problem", F.lit("retired")))


def register(requested: DataFrame, registry: DataFrame, fields: list[str], namespace: str, order: str) -> DataFrame:
    """The next version: the registry and an entry for each new identity, numbered in the order of ``order``.

    An identity that is requested twice or retired is a ValueError; one that is active keeps its id.
    """
    if wrong := request_problems(requested, registry, fields).take(20):
        raise ValueError(f"these can't be registered: {[(r.key, r.problem) for r in wrong]}")
    own = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))])
    known = registry.select(identity_key(F.col("identity")).alias("_key"))
    new = requested.select(own.alias("identity"), order).withColumn("_key", identity_key(F.col("identity"))).join(known, "_key", "left_anti")
    made = numbered(new, "_n", order, start=next_id(registry)).select(F.format_string(f"{namespace}-R%06d", "_n").alias("row_uid"), "identity", F.lit("active").alias("status"))
    return registry.select("row_uid", "identity", "status").unionByName(made)


def retire(registry: DataFrame, uids: DataFrame) -> DataFrame:
    """The next version with these ids retired; an id that is unknown or retired already is a ValueError."""
    active = registry.where("status = 'active'").select("row_uid")
    if wrong := uids.select("row_uid").distinct().join(active, "row_uid", "left_anti").take(20):
        raise ValueError(f"not active: {[r.row_uid for r in wrong]}")
    gone = uids.select("row_uid").distinct().withColumn("_gone", F.lit(True))
    return registry.join(gone, "row_uid", "left").select("row_uid", "identity", F.when(F.col("_gone"), "retired").otherwise(F.col("status")).alias("status"))
