"""Functions under names of their own in Spark SQL (section 2.15)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evspark.functions.text import DOI_PREFIXES, fold

# Bodies in SQL are inlined by the analyser: Catalyst sees through them like through built-in functions.
_J = "(1 - 3 / (4 * ({df}) - 1))"
_POOLED = "sqrt(try_divide((nt - 1) * st * st + (nc - 1) * sc * sc, nt + nc - 2))"
_ADD = "(CASE WHEN et = 0 OR et = nt OR ec = 0 OR ec = nc THEN 0.5D ELSE 0D END)"

SQL_FUNCTIONS = {
    "small_sample(df DOUBLE)": "1 - 3 / (4 * df - 1)",
    "hedges_g(mt DOUBLE, st DOUBLE, nt DOUBLE, mc DOUBLE, sc DOUBLE, nc DOUBLE)": f"{_J.format(df='nt + nc - 2')} * try_divide(mt - mc, {_POOLED})",
    "hedges_se(g DOUBLE, nt DOUBLE, nc DOUBLE)": "sqrt((nt + nc) / (nt * nc) + g * g / (2 * (nt + nc - 2)))",
    "log_odds_ratio(et DOUBLE, nt DOUBLE, ec DOUBLE, nc DOUBLE)": f"ln(et + {_ADD}) + ln(nc - ec + {_ADD}) - ln(nt - et + {_ADD}) - ln(ec + {_ADD})",
    "norm_doi(doi STRING)": "trim(" + "regexp_replace(" * len(DOI_PREFIXES) + "lower(trim(coalesce(doi, '')))"
    + "".join(f", '^{p.replace('.', '[.]')}', '')" for p in DOI_PREFIXES) + ")",
    "screening_text(x STRING)": r"lower(trim(regexp_replace(translate(coalesce(x, ''), '’‘', ''''''), '(?U)\\s+', ' ')))",
    "surname(author STRING)": "CASE WHEN contains(author, ',') THEN substring_index(author, ',', 1) ELSE substring_index(coalesce(author, ''), ' ', 1) END",
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions for this session; their names."""
    names = []
    for head, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
        names.append(head.partition("(")[0])

    @F.pandas_udf(T.StringType())
    def norm_text(texts):
        return texts.map(fold)

    spark.udf.register("norm_text", norm_text)
    return [*names, "norm_text"]
