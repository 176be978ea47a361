"""Rule-based screening of texts with evidence (FLT-4 to FLT-10, FN-5, FN-10, SRT-4, AGG-4, JN-7 to JN-9).

A table of criteria compiles to columns: terms and patterns become regular-expression literals, so that one scan with
code generation decides all criteria. Evidence snippets are a separate step, taken only for what is asked.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evspark.functions.text import SNIPPET, java_pattern, screening_text, snippets, term_pattern


@dataclass(frozen=True)
class Criterion:
    """Any of the lists may be empty. Without a supporting list everything that nothing blocks is supported."""

    id: str
    label: str = ""
    any_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()
    any_of_regex: tuple[str, ...] = ()
    none_of_regex: tuple[str, ...] = ()
    title_none_of: tuple[str, ...] = ()
    title_none_of_regex: tuple[str, ...] = ()
    field: str = ""
    field_any_of: tuple[str, ...] = ()
    check_at: tuple[str, ...] = ("ta", "ft")

    def __post_init__(self):
        for p in (*self.any_of_regex, *self.none_of_regex, *self.title_none_of_regex):
            re.compile(p)


# The reasons that are given.
SUPPORTED, VACUOUS, BLOCKED, UNSUPPORTED = "supporting term present", "nothing blocks this criterion", "blocking term present", "no supporting term found"
ALL_SUPPORTED, NO_ABSTRACT = "all checked criteria supported", "no abstract: kept for full-text screening"


def _hits(text: Column, terms: tuple[str, ...], patterns: tuple[str, ...] = ()) -> Column:
    parts = [text.rlike(term_pattern(t)) for t in terms] + [text.rlike(java_pattern(p)) for p in patterns]
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def reason(c: Criterion, text: Column, title: Column, field: Column | None = None) -> Column:
    """The one reason that decides a criterion, in the order field, blocking, vacuous, supporting (FLT-7).

    ``text`` and ``title`` are in screening form, ``field`` is the raw column of ``c.field``.
    """
    out = F
    if c.field and field is not None:
        value = screening_text(field)
        out = out.when((value != "") & ~_hits(value, c.field_any_of), f"the {c.field} field is not accepted")
    out = out.when(_hits(text, c.none_of, c.none_of_regex) | _hits(title, c.title_none_of, c.title_none_of_regex), BLOCKED)
    if not c.any_of and not c.any_of_regex:
        return out.otherwise(VACUOUS)
    return out.when(_hits(text, c.any_of, c.any_of_regex), SUPPORTED).otherwise(UNSUPPORTED)


def checked(criteria: list[Criterion], phase: str) -> list[Criterion]:
    return [c for c in criteria if phase in c.check_at]


def check_tables(criteria: list[Criterion], full_text: list[Criterion]) -> None:
    """A full-text table, if there is one, has the same criteria (FLT-8)."""
    odd = {c.id for c in criteria} ^ {c.id for c in full_text}
    if full_text and odd:
        raise ValueError("criteria of only one table: " + ", ".join(sorted(odd)))


def screen(records: DataFrame, criteria: list[Criterion], phase: str, version: str, text: str | None = None) -> DataFrame:
    """(record_id, phase, decision, reason, failed_criteria, rules_version, criteria) of each record.

    ``records`` has record_id, title, abstract and the fields that criteria name; in the full-text phase ``text``
    names the column of full texts. ``criteria`` is a map of the checked criteria to their reasons. In the first
    phase a record without an abstract is kept unseen, with an empty map (FLT-10). NULL texts are empty.
    """
    own = checked(criteria, phase)
    missing = {c.field for c in own if c.field} - set(records.columns)
    if missing:
        raise ValueError("criteria check columns that the records lack: " + ", ".join(sorted(missing)))
    blank = (F.trim(F.coalesce("abstract", F.lit(""))) == "") if phase == "ta" else F.lit(False)
    body = F.col(text) if text else F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    form = records.select(
        "record_id", blank.alias("_blank"), screening_text(body).alias("_text"), screening_text(F.col("title")).alias("_title"),
        *[F.col(f).alias(f"_field_{f}") for f in sorted({c.field for c in own if c.field})],
    )
    judged = form.select(
        "record_id", "_blank",
        *[reason(c, F.col("_text"), F.col("_title"), F.col(f"_field_{c.field}") if c.field else None).alias(f"_c{i}") for i, c in enumerate(own)],
    )
    fine = lambda i: F.col(f"_c{i}").isin(SUPPORTED, VACUOUS)
    failed = F.array_compact(F.array(*[F.when(~F.col("_blank") & ~fine(i), c.id) for i, c in enumerate(own)])) if own else F.array().cast("array<string>")
    reasons = F.map_from_arrays(F.array(*[F.lit(c.id) for c in own]), F.array(*[F.col(f"_c{i}") for i in range(len(own))])) if own else F.create_map().cast("map<string,string>")
    return judged.withColumn("_failed", failed).select(
        "record_id", F.lit(phase).alias("phase"), F.when(F.size("_failed") > 0, "exclude").otherwise("keep").alias("decision"),
        F.when(F.col("_blank"), NO_ABSTRACT).when(F.size("_failed") > 0, F.concat(F.lit("failed "), F.array_join("_failed", ", "))).otherwise(ALL_SUPPORTED).alias("reason"),
        F.array_join("_failed", ";").alias("failed_criteria"), F.lit(version).alias("rules_version"),
        F.when(F.col("_blank"), F.create_map().cast("map<string,string>")).otherwise(reasons).alias("criteria"),
    )


def evidence(records: DataFrame, criteria: list[Criterion], phase: str, text: str | None = None) -> DataFrame:
    """(record_id, criterion, supported, reason, evidence) of each record and checked criterion.

    Up to three snippets: of blocking hits in text and title, else of terms, else of patterns. A field that is not
    accepted gives its value.
    """
    body = F.col(text) if text else F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    out = None
    for c in checked(criteria, phase):
        rows = records.select(
            "record_id", screening_text(body).alias("t"), screening_text(F.col("title")).alias("h"), (F.col(c.field) if c.field else F.lit(None).cast("string")).alias("f")
        )
        why = reason(c, F.col("t"), F.col("h"), F.col("f") if c.field else None)
        rows = rows.withColumn("reason", why)
        # what is not asked for is NULL to the Python function
        when = lambda r, x: F.when(F.col("reason") == r, x)
        blocking = F.concat(
            snippets(when(BLOCKED, F.col("t")), list(c.none_of), list(c.none_of_regex)), snippets(when(BLOCKED, F.col("h")), list(c.title_none_of), list(c.title_none_of_regex))
        )
        terms, patterns = snippets(when(SUPPORTED, F.col("t")), list(c.any_of)), snippets(when(SUPPORTED, F.col("t")), [], list(c.any_of_regex))
        field = F.array(F.struct(F.lit(c.field).alias("term"), screening_text(F.col("f")).alias("snippet"))).cast(SNIPPET)
        rows = rows.withColumns({"_b": blocking, "_t": terms, "_p": patterns}).select(
            "record_id", F.lit(c.id).alias("criterion"), F.col("reason").isin(SUPPORTED, VACUOUS).alias("supported"), "reason",
            F.when(F.col("reason").startswith("the "), field).when(F.col("reason") == BLOCKED, F.slice("_b", 1, 3))
            .when(F.size("_t") > 0, F.col("_t")).otherwise(F.col("_p")).alias("evidence"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- between the phases


def coverage_gaps(records: DataFrame, decided: DataFrame) -> DataFrame:
    """(record_id, side): records without a decision and decisions without a record (JN-7); has to be empty."""
    a, b = records.select("record_id").distinct(), decided.select("record_id").distinct()
    one = lambda x, y, side: x.join(y, "record_id", "left_anti").select("record_id", F.lit(side).alias("side"))
    return one(a, b, "undecided").unionByName(one(b, a, "unknown"))


def full_text_input(records: DataFrame, decided: DataFrame, added: DataFrame, not_retrieved: DataFrame) -> DataFrame:
    """Records to screen on their full text: kept or added by audit, and retrieved (JN-8, JN-9)."""
    ids = decided.where("decision = 'keep'").select("record_id").union(added.select("record_id")).distinct()
    return records.join(ids, "record_id", "left_semi").join(not_retrieved.select("record_id"), "record_id", "left_anti")


def list_errors(records: DataFrame, decided: DataFrame, added: DataFrame, not_retrieved: DataFrame, texts: DataFrame) -> DataFrame:
    """(record_id, error): what must not be in the lists of added and not retrieved records; has to be empty."""
    kept = decided.where("decision = 'keep'").select("record_id")
    wanted = kept.union(added.select("record_id")).distinct()
    say = lambda df, error: df.select("record_id", F.lit(error).alias("error"))
    todo = wanted.join(not_retrieved, "record_id", "left_anti")
    return (
        say(added.join(records, "record_id", "left_anti"), "added but unknown")
        .unionByName(say(added.join(kept, "record_id", "left_semi"), "added but kept already"))
        .unionByName(say(not_retrieved.join(wanted, "record_id", "left_anti"), "not retrieved but not kept"))
        .unionByName(say(not_retrieved.join(texts, "record_id", "left_semi"), "not retrieved but has a text"))
        .unionByName(say(todo.join(texts, "record_id", "left_anti"), "text missing"))
    )


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision").agg(F.count("*").alias("n"))


def near_misses(decisions: DataFrame) -> DataFrame:
    """Records that fail just one criterion (FN-23)."""
    return decisions.where((F.col("failed_criteria") != "") & ~F.col("failed_criteria").contains(";"))
