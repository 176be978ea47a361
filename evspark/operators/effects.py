"""From coded rows to effects: pairing of arms, computability, effect sizes, dispersion checks (JN-12, ST-1 to ST-7)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evspark.functions import stats

#: Fixed: the inputs of each way of computing an effect.
NEEDED = {"means_sd": ("N", "mean", "sd"), "events_total": ("events", "total")}
KEYS = ("Study_ID", "Condition_ID", "Outcome_Metric")


def paired(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per comparison with the treatment's and the comparator's columns, t_ and c_.

    ``rows`` has the keys, Arm (treatment or comparator), ES_Path, Row_UID and the inputs. One aggregation: arms are
    never joined. ``problem`` says what makes a comparison ambiguous, else it is NULL.
    """
    values = [c for c in rows.columns if c not in (*keys, "Arm")]
    arm = lambda a: F.max(F.when(F.col("Arm") == a, F.struct(*values)))
    n = lambda a: F.count_if(F.col("Arm") == a)
    out = rows.groupBy(*keys).agg(arm("treatment").alias("t"), arm("comparator").alias("c"), n("treatment").alias("nt"), n("comparator").alias("nc"))
    problem = F.when((F.col("nt") != 1) | (F.col("nc") != 1), "not one row of each arm").when(~F.col("t.ES_Path").eqNullSafe(F.col("c.ES_Path")), "two paths")
    return out.withColumn("problem", problem).select(*keys, "problem", *[F.col(f"{s}.{v}").alias(f"{s}_{v}") for s in "tc" for v in values])


def computability(pairs: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, computable, missing): missing lists row and field of each input that is not there (ST-4, AGG-12)."""
    gaps = []
    for path, fields in NEEDED.items():
        for s in "tc":
            for f in fields:
                gap = (F.col("t_ES_Path") == path) & F.col(f"{s}_{f}").isNull()
                gaps.append(F.when(gap, F.struct(F.col(f"{s}_Row_UID").alias("Row_UID"), F.lit(f).alias("field"))))
    missing = F.array_sort(F.array_compact(F.array(*gaps)))
    return pairs.withColumn("missing", missing).select(*keys, (F.size("missing") == 0).alias("computable"), "missing")


def unexplained(missing: DataFrame, unresolved: DataFrame) -> DataFrame:
    """Missing inputs (Study_ID, Arm, field) that no unresolved item names (JN-13); has to be empty."""
    return missing.join(unresolved, ["Study_ID", "Arm", "field"], "left_anti")


def effects(pairs: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Effect of each comparison whose inputs pass the guards, by the path that its rows name.

    One pass over the comparisons; each step is a column of the next, so nothing is computed twice.
    """
    x = lambda c: F.col(c).cast("double")
    mean = F.col("t_ES_Path") == "means_sd"
    by = lambda a, b: F.when(mean, a).otherwise(b)
    means = [x(f"{s}_{c}") for s in "tc" for c in ("mean", "sd", "N")]
    events = [x(f"{s}_{c}") for s in "tc" for c in ("events", "total")]
    guard = F.when(mean, stats.means_guard(*means)).when(F.col("t_ES_Path") == "events_total", stats.events_guard(*events))
    (mt, st, nt, mc, sc, nc), (et, tt, ec, tc) = means, events
    half = F.when(stats.empty_cell(et, tt, ec, tc), 0.5).otherwise(0.0)
    c = F.col
    found = (
        pairs.where(guard == "ok")
        .withColumns({"_sd": by(stats.pooled_sd(st, nt, sc, nc), None), "_h": by(0.0, half)})
        .withColumns({"_a": et + c("_h"), "_b": tt - et + c("_h"), "_c": ec + c("_h"), "_d": tc - ec + c("_h")})
        .withColumn("_df", by(nt + nc - 2, c("_a") + c("_b") + c("_c") + c("_d") - 2))
        .withColumn("_j", stats.small_sample(c("_df")))
        .withColumn("g", c("_j") * by((mt - mc) / c("_sd"), (F.ln("_a") + F.ln("_d") - F.ln("_b") - F.ln("_c")) * math.sqrt(3) / math.pi))
        .withColumn("se", by(
            F.sqrt((nt + nc) / (nt * nc) + c("g") * c("g") / (2 * c("_df"))),
            F.abs("_j") * F.sqrt(3 * (1 / c("_a") + 1 / c("_b") + 1 / c("_c") + 1 / c("_d")) / (math.pi * math.pi)),
        ))
    )
    return found.select(
        *keys, c("t_Row_UID").alias("treatment_row"), c("c_Row_UID").alias("comparator_row"), "g", "se", (c("g") - 1.96 * c("se")).alias("ci_low"),
        (c("g") + 1.96 * c("se")).alias("ci_high"), by(F.lit("pooled_sd_hedges_g"), F.lit("log_or_derived_g")).alias("method"), (c("_h") > 0).alias("continuity_correction"),
    )


def pooled(found: DataFrame, by: tuple[str, ...] = ("method",)) -> DataFrame:
    """Inverse-variance mean of the effects of each method; methods are never mixed."""
    w = 1 / (F.col("se") * F.col("se"))
    return found.groupBy(*by).agg(F.count("*").alias("k"), (F.sum(w * F.col("g")) / F.sum(w)).alias("g"), F.sqrt(1 / F.sum(w)).alias("se"))


def dispersion_flags(
    rows: DataFrame, ratio: float = 3.0, study: str = "Study_ID", outcome: str = "Outcome_Metric", n: str = "N", sd: str = "sd", ids: tuple[str, ...] = ("Row_UID",)
) -> DataFrame:
    """(ids, value, N, rule, reference_sd): standard deviations that look like standard errors (ST-5, ST-6).

    A: smaller than the largest of the study's other rows by more than ``ratio``; the largest of all its rows serves,
    as a row that is smaller than it by such a ratio is not it. B, where A is not: smaller by the ratio than the
    median of the other studies' medians, and nearer to it after multiplying by the root of N. Only values above 0
    enter. The outcome's medians by study are aggregated first; what is sorted to leave one out is one row a study.
    """
    if not (math.isfinite(ratio) and ratio > 1):
        raise ValueError("the ratio has to be a finite number above 1")
    own = rows.select(*ids, F.col(study).alias("s"), F.col(outcome).alias("o"), F.expr(f"try_cast({n} AS DOUBLE)").alias("n"), F.expr(f"try_cast({sd} AS DOUBLE)").alias("sd"))
    own = own.where((F.col("sd") > 0) & (F.col("sd") < float("inf")))
    largest = own.groupBy("o", "s").agg(F.max("sd").alias("top"), F.median("sd").alias("m"))
    # the median without one study, from the ranks of the studies' medians
    w = Window.partitionBy("o")
    ranked = largest.withColumns({"k": F.row_number().over(w.orderBy("m", "s")), "all": F.count("*").over(w)})
    rest = F.col("all") - 1
    at = lambda i: F.when(F.col("k") <= i, i + 1).otherwise(i)
    lo, hi = F.floor((rest + 1) / 2).cast("int"), F.ceil((rest + 1) / 2).cast("int")
    need = ranked.withColumns({"lo": at(lo), "hi": at(hi)})
    value = lambda c: ranked.select("o", F.col("k").alias(c), F.col("m").alias("m_" + c))
    typical = (
        need.where("all > 1").join(value("lo"), ["o", "lo"]).join(value("hi"), ["o", "hi"])
        .select("o", "s", ((F.col("m_lo") + F.col("m_hi")) / 2).alias("typical"))
    )
    full = own.join(largest.select("o", "s", "top"), ["o", "s"]).join(typical, ["o", "s"], "left")
    a = F.col("sd") < F.col("top") / ratio
    far = F.abs(F.ln(F.col("sd") / F.col("typical")))
    b = (F.col("n") >= 2) & (F.col("sd") < F.col("typical") / ratio) & (F.abs(F.ln(F.col("sd") * F.sqrt("n") / F.col("typical"))) < far)
    flagged = full.withColumn("rule", F.when(a, "A").when(b, "B")).where("rule IS NOT NULL")
    return flagged.select(*ids, F.col("s").alias(study), F.col("o").alias(outcome), F.col("sd").alias("value"), F.col("n").alias("N"), "rule",
                          F.when(F.col("rule") == "A", F.col("top")).otherwise(F.col("typical")).alias("reference_sd"))
