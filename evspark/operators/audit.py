"""Audits: logged attempts, votes and their routing, challenges and reconciliation, seeded samples (VAL-4, VAL-8 to VAL-10, VAL-13, VAL-14, WIN-6, WIN-9, JN-15, JN-16)."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evspark.functions import jsonx

# ---- attempts


def json_object(text: Column, validate: Callable[[dict], bool] | None = None) -> Column:
    """STRUCT<ok, canonical> of a text that has to be one strict JSON object, and to pass ``validate`` if given."""

    @F.pandas_udf("ok boolean, canonical string")
    def read(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            try:
                value = jsonx.strict(t)
                ok = isinstance(value, dict) and (validate is None or bool(validate(value)))
                rows.append((ok, jsonx.canonical(value) if ok else None))
            except (ValueError, TypeError, KeyError, RecursionError):
                rows.append((False, None))
        return pd.DataFrame(rows, columns=["ok", "canonical"])

    return read(text)


def attempt_log(attempts: DataFrame, valid: Column) -> DataFrame:
    """(request_id, attempt, status, problem): VALID, INVALID_RESPONSE or TECHNICAL_FAILURE of each attempt (VAL-4).

    ``attempts`` has request_id, attempt and kind, typed in any case; ``valid`` says whether the answer counts.
    ``problem`` is NULL or what is wrong with the request's sequence: attempts are 1 to n without gaps or repeats, and
    none follows a valid one.
    """
    kind = F.regexp_replace(F.lower(F.trim("kind")), r"[\W_]+", "_")
    status = F.when(kind == "technical_error", "TECHNICAL_FAILURE").when((kind == "response") & F.coalesce(valid, F.lit(False)), "VALID").when(
        kind == "response", "INVALID_RESPONSE"
    )
    w = Window.partitionBy("request_id")
    out = attempts.select("request_id", F.col("attempt").cast("long").alias("attempt"), status.alias("status")).withColumns({
        "k": F.row_number().over(w.orderBy("attempt")), "first": F.min(F.when(F.col("status") == "VALID", F.col("attempt"))).over(w),
    })
    problem = (
        F.when(F.col("status").isNull(), "unknown kind").when(F.col("attempt") != F.col("k"), "attempts are not 1 to n")
        .when(F.col("attempt") > F.col("first"), "attempt after a valid one")
    )
    return out.select("request_id", "attempt", "status", problem.alias("problem"))


def resolved(log: DataFrame) -> DataFrame:
    """(request_id, attempts, technical_failures, invalid, accepted): one row a request; accepted is the first valid
    attempt, NULL if none is, which is neither a pass nor an exclusion."""
    is_ = lambda s: F.col("status") == s
    return log.groupBy("request_id").agg(
        F.count("*").alias("attempts"), F.count_if(is_("TECHNICAL_FAILURE")).alias("technical_failures"), F.count_if(is_("INVALID_RESPONSE")).alias("invalid"),
        F.min(F.when(is_("VALID"), F.col("attempt"))).alias("accepted"),
    )


def request_gaps(requests: DataFrame, attempts: DataFrame) -> DataFrame:
    """(request_id, problem): requests never used and attempts of no request; has to be empty."""
    a, b = requests.select("request_id").distinct(), attempts.select("request_id").distinct()
    one = lambda x, y, say: x.join(y, "request_id", "left_anti").select("request_id", F.lit(say).alias("problem"))
    return one(a, b, "unused request").unionByName(one(b, a, "unknown request"))


def request_identity(requests: DataFrame) -> DataFrame:
    """(request_id, expected_id, sha_ok): the id that the canonical form of a request gives, and whether the hash is
    that of this form or of the text as it stands (SRC-11)."""

    @F.pandas_udf("expected_id string, sha string")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            try:
                digest = jsonx.sha256(jsonx.canonical(jsonx.strict(t)))
                rows.append(("REQ-" + digest[:20], digest))
            except (ValueError, TypeError, RecursionError):
                rows.append((None, None))
        return pd.DataFrame(rows, columns=["expected_id", "sha"])

    found = requests.withColumn("_of", of("request"))
    return found.select("request_id", "_of.expected_id", F.coalesce(F.col("request_sha256").isin(F.col("_of.sha"), F.sha2("request", 256)), F.lit(False)).alias("sha_ok"))


def single_valid_object(candidates: DataFrame, valid: Column) -> DataFrame:
    """Requests whose answer holds several objects, of which just one is valid, with that one (VAL-14)."""
    n = F.count_if(valid).over(Window.partitionBy("request_id"))
    return candidates.withColumn("_n", n).where(valid & (F.col("_n") == 1)).drop("_n")


# ---- votes


def routed_votes(votes: DataFrame) -> DataFrame:
    """(source_id, votes, majority, route) from votes (source_id, reviewer, decision) (VAL-9, AGG-5, AGG-6).

    Two reviewers vote; if they differ a third is asked; the majority is include only if more say so, so that a tie
    excludes; only then a person decides. ``route`` is third, human or done.
    """
    n = lambda d: F.count_if(F.col("decision") == d)
    out = votes.groupBy("source_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("reviewer", "decision"))), lambda v: v["decision"]), ",").alias("votes"),
        n("include").alias("yes"), n("exclude").alias("no"),
    )
    majority = F.when(F.col("yes") > F.col("no"), "include").otherwise("exclude")
    route = F.when((F.col("yes") == 1) & (F.col("no") == 1), "third").when(majority == "include", "human").otherwise("done")
    return out.select("source_id", "votes", majority.alias("majority"), route.alias("route"))


def confirmed(routed: DataFrame, human: DataFrame) -> DataFrame:
    """(source_id, majority, final, problem): include only where a person says so too (JN-10)."""
    out = routed.join(human.select("source_id", F.col("decision").alias("human")), "source_id", "full_outer")
    problem = (
        F.when(F.col("majority").isNull() | (F.col("majority") != "include") & F.col("human").isNotNull(), "unused adjudication")
        .when((F.col("majority") == "include") & F.col("human").isNull(), "adjudication missing")
    )
    final = F.when((F.col("majority") == "include") & (F.col("human") == "include"), "include").otherwise("exclude")
    return out.select("source_id", "majority", final.alias("final"), problem.alias("problem"))


def rule_versions(candidates: DataFrame, rules: DataFrame, holds: Column) -> DataFrame:
    """Every candidate under every rule version, with ``included`` (VAL-10, FLT-12).

    ``rules`` has one row a version: a table that people write, broadcast only up to a thousand rows.
    """
    if rules.limit(1001).count() > 1000:
        raise ValueError("more than a thousand rule versions")
    return candidates.crossJoin(F.broadcast(rules)).withColumn("included", F.coalesce(holds, F.lit(False)))


def revision_errors(screened: DataFrame, confirmed_misses: DataFrame, audited: DataFrame, version: str) -> DataFrame:
    """(source_id, problem): confirmed misses that the version leaves out, and its exclusions nobody audited."""
    own = screened.where(F.col("version") == version)
    missed = own.where("NOT included").join(confirmed_misses.select("source_id"), "source_id", "left_semi")
    fresh = own.where("NOT included").join(audited.select("source_id"), "source_id", "left_anti")
    say = lambda df, p: df.select("source_id", F.lit(p).alias("problem"))
    return say(missed, "confirmed miss still excluded").unionByName(say(fresh, "exclusion without an audit"))


# ---- challenges


@F.pandas_udf(T.BooleanType())
def same_json(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two JSON texts are the same value: numbers by value, the rest by canonical form (FN-13)."""
    return pd.Series([jsonx.same_value(json.loads(x), json.loads(y)) for x, y in zip(a, b, strict=True)])


def routed_challenges(challenges: DataFrame, adjudicated: DataFrame) -> DataFrame:
    """(Row_UID, field, old, new, outcome) of each challenge (VAL-8, JN-15).

    ``challenges`` has Row_UID, field, current and proposed, ``adjudicated`` Row_UID, field and value, as JSON texts.
    The adjudicator's value settles it: equal to the current one the challenge is rejected, equal to the proposed one
    it is a correction, else a person has to decide; so too if nobody adjudicated.
    """
    both = challenges.join(adjudicated, ["Row_UID", "field"], "left")
    value = F.coalesce("value", F.lit("null"))
    outcome = (
        F.when(F.col("value").isNull(), "needs_human").when(same_json(value, F.coalesce("current", F.lit("null"))), "rejected")
        .when(same_json(value, F.coalesce("proposed", F.lit("null"))), "correction").otherwise("needs_human")
    )
    return both.select("Row_UID", "field", F.col("current").alias("old"), F.col("value").alias("new"), outcome.alias("outcome"))


def reconciled(rows: DataFrame, corrections: DataFrame, fields: list[str], key: str = "Row_UID") -> DataFrame:
    """Rows with confirmed corrections (key, field, new) put in; the originals are not touched (JN-16).

    A value that cannot be read as its column's type is an error, never a silent NULL.
    """
    types = dict(rows.dtypes)
    wide = corrections.groupBy(key).agg(*[F.max(F.when(F.col("field") == f, F.struct("new"))).alias(f"_new_{f}") for f in fields])
    out = rows.join(wide, key, "left")
    put = {f: F.when(F.col(f"_new_{f}").isNotNull(), F.col(f"_new_{f}.new").cast(types[f])).otherwise(F.col(f)) for f in fields}
    return out.withColumns(put).select(*rows.columns)


# ---- samples


def seeded_order(key: Column, seed: str) -> Column:
    """A place in an order that a seed fixes and that is the same in every engine with SHA-256 (WIN-9)."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def seeded_sample(rows: DataFrame, key: str, strata: list[str], seed: str, first: int, last: int) -> DataFrame:
    """Rows ``first`` to ``last`` of each stratum in the seeded order: later rounds go on where earlier ones ended."""
    w = Window.partitionBy(*strata).orderBy(seeded_order(F.col(key), seed), key)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place").between(first, last))


def round_totals(rounds: DataFrame) -> DataFrame:
    """Cumulative audited and missed counts of rounds (stratum, round, audited, missed) and whether the last two rounds
    of a stratum found nothing (VAL-13)."""
    w = Window.partitionBy("stratum").orderBy("round")
    total = w.rowsBetween(Window.unboundedPreceding, 0)
    return rounds.withColumns({
        "audited_so_far": F.sum("audited").over(total), "missed_so_far": F.sum("missed").over(total),
        "may_stop": F.coalesce((F.col("missed") == 0) & (F.lag("missed").over(w) == 0), F.lit(False)),
    })
