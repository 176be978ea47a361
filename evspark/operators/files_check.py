"""Checks over a table of files (FLT-18, FLT-19): credentials, private places, broken links; and templates (FN-21)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shapes of credentials.
CREDENTIALS = {
    "private key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----", "access key": r"\bAKIA[0-9A-Z]{16}\b",
    "code host token": r"\b(?:ghp_|github_pat_)[A-Za-z0-9_]{30,}\b", "service key": r"\bsk-(?:proj-)?[A-Za-z0-9_-]{32,}\b",
}


def credentials(files: DataFrame) -> DataFrame:
    """(path, kind): files (path, text) that hold something like a credential."""
    hits = F.array_compact(F.array(*[F.when(F.col("text").rlike(p), F.lit(k)) for k, p in CREDENTIALS.items()]))
    return files.select("path", F.explode(hits).alias("kind"))


def not_public(files: DataFrame, denied_parts: list[str], suffixes: list[str]) -> DataFrame:
    """(path): files below a denied folder, or with an ending that is not allowed."""
    parts = F.split("path", "/")
    bad = F.arrays_overlap(parts, F.array(*map(F.lit, denied_parts))) if denied_parts else F.lit(False)
    ending = F.concat(F.lit("."), F.substring_index("path", ".", -1))
    return files.where(bad | ~ending.isin(suffixes)).select("path")


def broken_links(files: DataFrame) -> DataFrame:
    """(path, target): local links of Markdown files, outside fenced code, to files that are not in the table."""
    md = files.where("path LIKE '%.md'").withColumn("t", F.regexp_replace("text", r"(?s)```.*?```", ""))
    links = md.select("path", F.explode(F.regexp_extract_all("t", F.lit(r"\]\(([^)\s#]+)[^)]*\)"), 1)).alias("target")).where(~F.col("target").rlike("^[a-z]+:|^#"))
    folder = F.regexp_replace("path", "[^/]*$", "")
    full = F.when(F.startswith("target", F.lit("/")), F.substring(F.col("target"), F.lit(2), F.length("target"))).otherwise(F.concat(folder, F.regexp_replace("target", r"^(?:\./)+", "")))
    for _ in range(8):  # folders up
        full = F.regexp_replace(full, r"(^|/)(?!\.\./)[^/]+/\.\./", "$1")
    known = files.select(F.col("path").alias("to"))
    return links.withColumn("to", full).join(known, "to", "left_anti").select("path", "target")


def render(template: str, values: dict[str, str], verbatim: dict[str, str] = {}) -> str:  # noqa: B006
    """A text with its {{NAME}} fields filled; a name without a value is an error, ``verbatim`` ones cannot be replaced."""
    if clash := set(values) & set(verbatim):
        raise ValueError("reserved names: " + ", ".join(sorted(clash)))
    known = values | verbatim

    def put(m: re.Match) -> str:
        if m[1] not in known:
            raise ValueError(f"no value for {m[1]}")
        return known[m[1]]

    return re.sub(r"\{\{([A-Z][A-Z0-9_]*)\}\}", put, template)
