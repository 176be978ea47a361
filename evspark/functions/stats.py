"""Effect sizes as column expressions (ST-1 to ST-3). Everything stays in whole-stage code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def small_sample(df: Column) -> Column:
    return 1 - 3 / (4 * df - 1)


def _effect(g: Column, se: Column, status: Column, method: str, corrected: Column) -> Column:
    ok = status == "ok"
    finite = lambda x: F.when(ok, x)
    return F.struct(
        finite(g).alias("g"), finite(se).alias("se"), finite(g - 1.96 * se).alias("ci_low"), finite(g + 1.96 * se).alias("ci_high"),
        F.lit(method).alias("method"), corrected.alias("continuity_correction"), status.alias("status"),
    )


#: Inputs beyond this are taken for broken: their squares and products have to stay finite. So the guards need to look
#: at inputs only, and the generated code stays small.
LARGEST = 1e75


def _bad(x: Column) -> Column:
    return x.isNull() | F.isnan(x) | (F.abs(x) > LARGEST)


def means_guard(mt: Column, st: Column, nt: Column, mc: Column, sc: Column, nc: Column) -> Column:
    """ok, or the first guard that fails: missing or not finite, n (a whole number of 2 or more), sd (0 or more),
    variance (pooled, more than 0) (ST-3)."""
    mt, st, nt, mc, sc, nc = (x.cast("double") for x in (mt, st, nt, mc, sc, nc))
    return (
        F.when(_bad(mt) | _bad(st) | _bad(nt) | _bad(mc) | _bad(sc) | _bad(nc), "not finite")
        .when((nt < 2) | (nc < 2) | (nt != F.floor(nt)) | (nc != F.floor(nc)), "n")
        .when((st < 0) | (sc < 0), "sd")
        .when(~((nt - 1) * st * st + (nc - 1) * sc * sc > 0), "variance")
        .otherwise("ok")
    )


def events_guard(et: Column, nt: Column, ec: Column, nc: Column) -> Column:
    """ok, or the first guard that fails: missing or not finite, n, events (from 0 to the group's total) (ST-3)."""
    et, nt, ec, nc = (x.cast("double") for x in (et, nt, ec, nc))
    return (
        F.when(_bad(et) | _bad(nt) | _bad(ec) | _bad(nc), "not finite")
        .when((nt < 2) | (nc < 2) | (nt != F.floor(nt)) | (nc != F.floor(nc)), "n")
        .when((et < 0) | (ec < 0) | (et > nt) | (ec > nc), "events")
        .otherwise("ok")
    )


def pooled_sd(st: Column, nt: Column, sc: Column, nc: Column) -> Column:
    return F.sqrt(F.try_divide((nt - 1) * st * st + (nc - 1) * sc * sc, nt + nc - 2))


def empty_cell(et: Column, nt: Column, ec: Column, nc: Column) -> Column:
    return (et == 0) | (nt == et) | (ec == 0) | (nc == ec)


def hedges_g(mt: Column, st: Column, nt: Column, mc: Column, sc: Column, nc: Column) -> Column:
    """Standardised mean difference of independent groups with small-sample correction (ST-1).

    STRUCT<g, se, ci_low, ci_high, method, continuity_correction, status>, with the status of ``means_guard``. For
    many rows with a filter on the status, ``operators.effects.effects`` builds the columns one after the other, which
    keeps the generated code small.
    """
    status = means_guard(mt, st, nt, mc, sc, nc)
    mt, st, nt, mc, sc, nc = (x.cast("double") for x in (mt, st, nt, mc, sc, nc))
    df = nt + nc - 2
    g = small_sample(df) * F.try_divide(mt - mc, pooled_sd(st, nt, sc, nc))
    se = F.sqrt(F.try_divide(nt + nc, nt * nc) + F.try_divide(g * g, 2 * df))
    return _effect(g, se, status, "pooled_sd_hedges_g", F.lit(False))


def log_odds_g(et: Column, nt: Column, ec: Column, nc: Column) -> Column:
    """Hedges g from the log odds ratio of two groups' events (ST-2).

    If one of the four cells is empty, 0.5 is added to each of them, which also enters the degrees of freedom.
    The status is that of ``events_guard``.
    """
    status = events_guard(et, nt, ec, nc)
    et, nt, ec, nc = (x.cast("double") for x in (et, nt, ec, nc))
    zero = empty_cell(et, nt, ec, nc)
    add = F.when(zero, 0.5).otherwise(0.0)
    a, b, c, d = et + add, nt - et + add, ec + add, nc - ec + add
    log_ratio = F.ln(a) + F.ln(d) - F.ln(b) - F.ln(c)
    variance = F.try_divide(F.lit(1.0), a) + F.try_divide(F.lit(1.0), b) + F.try_divide(F.lit(1.0), c) + F.try_divide(F.lit(1.0), d)
    j = small_sample(a + b + c + d - 2)
    g = j * log_ratio * math.sqrt(3) / math.pi
    se = F.abs(j) * F.sqrt(3 * variance / (math.pi * math.pi))
    return _effect(g, se, status, "log_or_derived_g", F.coalesce(zero, F.lit(False)))
