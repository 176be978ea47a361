"""Answers checked against the request they belong to (VAL-5 to VAL-7), requests that say too little or too much (VAL-11),
adjudications in three outcomes (VAL-12), and states of preparation (VAL-15).

A check is a function of an answer and its request, both read as strict JSON; it yields what is wrong. ``checked`` runs one
over a table of attempts in Arrow batches, and the first fault is the attempt's ``problem``, so that an attempt is valid
for ``audit.attempt_log`` where it has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evspark.functions import jsonx
from evspark.operators.codebook import Domain, path_error, row_faults

Check = Callable[[dict, dict], Iterator[str]]


def quotation_fault(evidence, request: dict, only: str | None = None) -> str | None:
    """What is wrong with a quotation (source_id, line, quote) of a source of the request; ``only`` names the one allowed."""
    if not isinstance(evidence, dict) or sorted(evidence) != ["line", "quote", "source_id"]:
        return "no quotation"
    texts = {s.get("source_id"): s.get("text") for s in request.get("sources") or [] if isinstance(s, dict)}
    text, line, quote = texts.get(evidence["source_id"]) if isinstance(evidence["source_id"], str) else None, evidence["line"], evidence["quote"]
    if not isinstance(text, str) or (only is not None and evidence["source_id"] != only):
        return "quotation of another source"
    rows = text.splitlines()
    if type(line) is not int or not 1 <= line <= len(rows):
        return "line out of range"
    return None if isinstance(quote, str) and quote and quote in rows[line - 1] else "quotation not on its line"


def screening_answer(criteria: set[str], more: tuple[str, ...] = ()) -> Check:
    """VAL-5: a decision, the criteria it rests on, and a quotation; ``more`` are keys that may stand beside them."""

    def check(answer: dict, request: dict) -> Iterator[str]:
        if {"decision", "criterion_ids", "evidence"} != answer.keys() - set(more):
            yield "other keys"
            return
        if answer["decision"] not in ("include", "exclude"):
            yield "no decision"
        ids = answer["criterion_ids"]
        if not isinstance(ids, list) or not ids or not all(isinstance(x, str) and x in criteria for x in ids):
            yield "unknown criteria"
        if fault := quotation_fault(answer["evidence"], request):
            yield fault

    return check


def coding_answer(codebook: dict, arms: tuple[str, ...] = ("treatment", "comparator"), inputs: tuple[str, ...] = ("N", "mean", "sd", "events", "total")) -> Check:
    """VAL-6: one row of each arm of the request's study that fits the codebook and its way of computing, and just one
    quotation from the request's source for each number given."""
    domains = {v["name"]: Domain.of(v) for v in codebook["variables"] if v["owner"] == "executor"}
    lists = ("rows", "evidence", "unresolved_items", "skipped_conditions", "warnings")

    def check(answer: dict, request: dict) -> Iterator[str]:
        if sorted(answer) != sorted(lists) or not all(isinstance(answer[k], list) for k in lists):
            yield "other keys"
            return
        rows = answer["rows"]
        faults = [f for r in rows for f in row_faults(r, domains)]
        if faults:
            yield from faults
            return
        if sorted(r["Arm"] for r in rows) != sorted(arms):
            yield "not one row of each arm"
        if any(r["Study_ID"] != request.get("study_id") for r in rows):
            yield "a row of another study"
        yield from filter(None, map(path_error, rows))
        told = []
        for e in answer["evidence"]:
            if not isinstance(e, dict) or sorted(e) != ["Arm", "field", "source"]:
                yield "evidence for no field"
                continue
            told.append((e["Arm"], e["field"]))
            if fault := quotation_fault(e["source"], request, request.get("source_id")):
                yield fault
        if sorted(told, key=str) != sorted(((r["Arm"], f) for r in rows for f in inputs if r.get(f) is not None), key=str):
            yield "evidence and numbers differ"

    return check


def audit_answer(codebook: dict, domains: list, rules: set[str]) -> Check:
    """VAL-7: the auditor looked at exactly the request's rows and domains, and passes them or challenges single values."""
    own = {v["name"]: Domain.of(v) for v in codebook["variables"] if v["owner"] == "executor"}
    open_ = own.keys() - set(codebook["unit"]["identity_fields"])

    def check(answer: dict, request: dict) -> Iterator[str]:
        if sorted(answer) != ["challenges", "checked_rows", "domains", "status"] or not isinstance(answer["challenges"], list) or not isinstance(answer["checked_rows"], list):
            yield "other keys"
            return
        rows = [r["Row_UID"] for r in request.get("targets") or []]
        if sorted(map(str, answer["checked_rows"])) != sorted(rows):
            yield "other rows"
        if answer["domains"] != domains:
            yield "other domains"
        if answer["status"] != ("CHALLENGE" if answer["challenges"] else "PASS"):
            yield "status and challenges differ"
        places = set()
        for c in answer["challenges"]:
            if not isinstance(c, dict) or sorted(c) != ["Row_UID", "evidence", "field", "proposed", "rule"]:
                yield "no challenge"
                continue
            place = (str(c["Row_UID"]), str(c["field"]))
            if c["Row_UID"] not in rows or c["field"] not in open_:
                yield "a challenge of what is fixed"
            elif place in places:
                yield "a value challenged twice"
            else:
                yield from own[c["field"]].faults(c["proposed"])
            places.add(place)
            if c["rule"] not in rules:
                yield "an unknown rule"
            if fault := quotation_fault(c["evidence"], request):
                yield fault

    return check


def checked(attempts: DataFrame, requests: DataFrame, check: Check) -> DataFrame:
    """(request_id, attempt, kind, problem): attempts with the first fault of their answer, NULL if it is valid.

    ``attempts`` has request_id, attempt, kind and raw_text, ``requests`` request_id and request, of which one row a request
    counts. An answer that is no strict JSON object has the problem "no object", one to no request "no request".
    """
    asked = requests.groupBy("request_id").agg(F.min("request").alias("request"))

    def run(batches):
        for pdf in batches:
            out = []
            for raw, told in zip(pdf["raw_text"], pdf["request"], strict=True):
                try:
                    answer = jsonx.strict(raw)
                except (ValueError, TypeError, RecursionError):
                    answer = None
                if told is None:
                    out.append("no request")
                elif not isinstance(answer, dict):
                    out.append("no object")
                else:
                    out.append(next(check(answer, jsonx.strict(told)), None))
            yield pd.DataFrame({"request_id": pdf["request_id"], "attempt": pdf["attempt"], "kind": pdf["kind"], "problem": pd.Series(out, dtype="object")})

    rows = attempts.select("request_id", F.col("attempt").cast("long").alias("attempt"), "kind", "raw_text").join(asked, "request_id", "left")
    return rows.mapInPandas(run, "request_id string, attempt long, kind string, problem string")


# ---- what a reviewer may see


def blinded(rows: DataFrame, seen: list[str]) -> DataFrame:
    """The columns that a reviewer may see, and no other ones (VAL-11); one that is not there is an error."""
    return rows.select(*seen)


def shows(request: Column, hidden: list[str]) -> Column:
    """The first of these keys that a request (a JSON text) has at any depth, NULL if it has none (VAL-11)."""
    names = "|".join(hidden)
    found = F.regexp_extract(request, rf'(?:^|[^\\])"({names})"\s*:', 1)
    return F.when(found != "", found)


# Outcomes of an adjudication.
SUPPORTED, CORRECTED, AMBIGUOUS = "CURRENT_CODING_SUPPORTED", "CORRECTION_SUPPORTED", "SOURCE_OR_RULE_AMBIGUOUS"


def three_way(judged: DataFrame) -> DataFrame:
    """Rows (outcome, corrected, proposed, ...) with ``route``: rejected, correction, needs_human, or malformed (VAL-12).

    A correction holds only if the corrected value is the proposal that the adjudicator did not see; the other outcomes
    have no corrected value. Values are JSON texts in canonical form.
    """
    none = F.col("corrected").isNull()
    route = (
        F.when(F.col("outcome").isin(SUPPORTED, AMBIGUOUS) & ~none | (F.col("outcome") == CORRECTED) & none, "malformed")
        .when(F.col("outcome") == SUPPORTED, "rejected").when(F.col("outcome") == AMBIGUOUS, "needs_human")
        .when(F.col("outcome") == CORRECTED, F.when(F.col("corrected").eqNullSafe(F.col("proposed")), "correction").otherwise("needs_human"))
        .otherwise("malformed")
    )
    return judged.withColumn("route", route)


def tracked(states: DataFrame) -> DataFrame:
    """Rows (reviewed, available, prepared, coded) with ``problem``: a state that was reached without the one it needs (VAL-15).

    The four states stay apart: what is prepared is not coded.
    """
    told = lambda c: F.coalesce(F.col(c), F.lit(False))
    steps = ("reviewed", "available", "prepared", "coded")
    problem = F.coalesce(*[F.when(told(b) & ~told(a), F.lit(f"{b} but not {a}")) for a, b in zip(steps, steps[1:])])
    return states.withColumn("problem", problem)


def differing(found: DataFrame, expected: DataFrame, keys: list[str], tolerance: float = 1e-12) -> DataFrame:
    """(keys, column): cells that differ between two tables, and rows that only one has (column NULL) (ST-8).

    Floating numbers may differ by ``tolerance``, absolutely or relative to the larger; all else has to be equal.
    """
    types = dict(expected.dtypes)
    if types != dict(found.dtypes):
        raise ValueError("the columns or their types differ")
    values = [c for c in expected.columns if c not in keys]
    side = lambda df, s: df.select(*keys, F.struct(*values, F.lit(1).alias("_in")).alias(s))
    both = side(found, "a").join(side(expected, "b"), keys, "full_outer")

    def differs(c: str) -> Column:
        a, b = F.col(f"a.{c}"), F.col(f"b.{c}")
        if types[c] not in ("double", "float"):
            return ~a.eqNullSafe(b)
        near = F.abs(a - b) <= F.greatest(F.lit(tolerance), tolerance * F.greatest(F.abs(a), F.abs(b)))
        return ~F.when(a.isNull() | b.isNull() | F.isnan(a) | F.isnan(b), a.eqNullSafe(b)).otherwise((a == b) | near)

    missing = F.col("a").isNull() | F.col("b").isNull()
    cells = F.array_compact(F.array(*[F.when(differs(c), F.lit(c)) for c in values]))
    return both.where(missing).select(*keys, F.lit(None).cast("string").alias("column")).unionByName(both.where(~missing).select(*keys, F.explode(cells).alias("column")))
