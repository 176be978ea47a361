"""Strict and canonical JSON (SRC-10, SNK-5, FN-13)."""

from __future__ import annotations

import hashlib
import json
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pairs(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("duplicate key")
    return out


def _finite(value: str) -> float:
    x = float(value)
    if not math.isfinite(x):
        raise ValueError("number out of range")
    return x


def _constant(value: str) -> None:
    raise ValueError(f"{value} is no JSON number")


def strict(text: str):
    """One JSON value, with unique keys and finite numbers; anything else is a ValueError."""
    return json.loads(text, object_pairs_hook=_pairs, parse_float=_finite, parse_constant=_constant)


def canonical(value) -> str:
    """Sorted keys, no spaces, text as it is."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def pretty(value) -> str:
    return json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n"


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def same_value(a, b) -> bool:
    """Numbers by value, booleans apart from numbers, anything else by canonical form."""
    number = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)
    return float(a) == float(b) if number(a) and number(b) else canonical(a) == canonical(b)


@F.pandas_udf(T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("canonical", T.StringType()), T.StructField("error", T.StringType())]))
def _strict_udf(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        try:
            if text is None:
                raise ValueError("no text")
            rows.append((True, canonical(strict(text)), None))
        except (ValueError, RecursionError) as e:
            rows.append((False, None, str(e).split(":")[0][:200]))
    return pd.DataFrame(rows, columns=["ok", "canonical", "error"])


def strict_json(column: Column) -> Column:
    """STRUCT<ok, canonical, error> of a text read as strict JSON; NULL is an error."""
    return _strict_udf(column)
