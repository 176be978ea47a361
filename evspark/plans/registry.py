"""Named queries of the core, bound to the test tables, with equivalent SQL."""

from __future__ import annotations

from evspark.plans import core
from evspark.sources import csv_rows

MODULES: tuple = (core, csv_rows)


def queries() -> dict:
    return {name: f for module in MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
