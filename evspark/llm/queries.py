"""Queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from evspark.llm import encoding, exact, groups, leakage, names, packing, residue, responses, survivors

MODULES = (encoding, names, groups, exact, survivors, leakage, names, packing, residue, responses)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in vars(m).items() if k.startswith("p") and k[1:2].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in getattr(m, "ORACLE", {}).items()}
