"""Readers and writers of the project's own files (SRC-6 to SRC-16, SNK-1 to SNK-8).

Checks come back as tables of violations or raise, as one row is enough to refuse an input. Writers never overwrite.
"""

from __future__ import annotations

import re
import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.functions import jsonx
from evspark.functions.jsonx import strict_json
from evspark.operators.provenance import digest, write_new


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...]) -> DataFrame:
    """A CSV file with a header, all columns strings, missing values "". A byte-order mark is no fault."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False).csv(path)
    names = {c: c.lstrip("﻿") for c in raw.columns}
    out = raw.withColumnsRenamed({a: b for a, b in names.items() if a != b}).na.fill("")
    lacking = [c for c in required if c not in out.columns]
    if lacking:
        raise ValueError("columns missing: " + ", ".join(lacking))
    return out


def id_errors(rows: DataFrame, key: str = "record_id") -> DataFrame:
    """(id, error): blank ids and ids given twice; has to be empty."""
    n = rows.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))
    error = F.when(F.trim(F.coalesce("id", F.lit(""))) == "", "blank id").when(F.col("n") > 1, "id given twice")
    return n.withColumn("error", error).where("error IS NOT NULL").select("id", "error")


def require_none(violations: DataFrame, message: str, shown: int = 10) -> None:
    """Raise with the first few violations if there are any (SRT-5)."""
    if found := violations.limit(shown).collect():
        raise ValueError(message + ": " + "; ".join(", ".join(map(str, r)) for r in found))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: record_id, title, abstract and any other columns; ids are unique and not blank."""
    out = read_csv(spark, path, ("record_id", "title", "abstract"))
    if out.isEmpty():
        raise ValueError("no records")
    require_none(id_errors(out), "record ids")
    return out


def read_first_phase(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    """Decisions of an earlier run, and the hash of the records that it read (SRC-7)."""
    out = read_csv(spark, f"{folder}/decisions.csv", ("record_id", "phase", "decision"))
    require_none(out.where("phase <> 'ta'").select("record_id", "phase"), "not of the first phase")
    require_none(id_errors(out), "record ids")
    require_none(out.where("decision NOT IN ('keep', 'exclude')").select("record_id", "decision"), "unknown decisions")
    summary = Path(folder) / "summary.json"
    if not summary.is_file():
        raise ValueError("the summary of the earlier run is missing")
    recorded = jsonx.strict(summary.read_text(encoding="utf-8")).get("input_sha256")
    if not isinstance(recorded, str) or not re.fullmatch("[0-9a-f]{64}", recorded):
        raise ValueError("the summary names no input hash")
    return out, recorded


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: one id a line, # begins a comment line."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", "^\\x{FEFF}", "")).alias("record_id"))
    return lines.where("record_id <> '' AND NOT startswith(record_id, '#')").distinct()


def read_full_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, text): one file record_id.txt each (SRC-9)."""
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt")
    return raw.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "").alias("record_id"), F.col("value").alias("text"))


def read_json_lines(spark: SparkSession, path: str, keys: tuple[str, ...]) -> DataFrame:
    """(line, value, problem) of a JSONL file: strict JSON objects with exactly these keys (SRC-11); blank lines are
    skipped. ``value`` is the canonical form."""
    raw = spark.read.text(path).where("trim(value) <> ''").withColumn("j", strict_json(F.col("value")))
    own = F.array_sort(F.json_object_keys("j.canonical"))
    problem = F.when(~F.col("j.ok"), F.col("j.error")).when(~F.coalesce(own == F.array(*[F.lit(k) for k in sorted(keys)]), F.lit(False)), "other keys")
    return raw.select(F.col("value").alias("line"), F.col("j.canonical").alias("value"), problem.alias("problem"))


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """SRC-13, in the order of the file: one file that people write, read as one partition."""
    out = read_csv(spark, path, ("record_id_a", "record_id_b", "decision"))
    require_none(out.where("decision NOT IN ('duplicate', 'not_duplicate')").select("record_id_a", "record_id_b", "decision"), "unknown decisions")
    if "note" not in out.columns:
        out = out.withColumn("note", F.lit(""))
    return out.coalesce(1).withColumn("decision_ord", F.monotonically_increasing_id())


def read_coded_rows(spark: SparkSession, path: str, study: str = "Study_ID", outcome: str = "Outcome_Metric", n: str = "N", sd: str = "sd", ids: tuple[str, ...] = ("Row_UID",)) -> DataFrame:
    """SRC-14: coded rows under any column names."""
    return read_csv(spark, path, (study, outcome, n, sd, *ids))


def read_config(path: Path, required: dict[str, type]) -> dict:
    """SRC-16: a JSON object with these keys and types."""
    out = jsonx.strict(path.read_text(encoding="utf-8"))
    wrong = [k for k, kind in required.items() if not isinstance(out, dict) or not isinstance(out.get(k), kind)]
    if wrong:
        raise ValueError("configuration lacks " + ", ".join(wrong))
    return out


def abstract_sources(records: DataFrame) -> DataFrame:
    """(source_id, text): title and abstract as a source of their own (SRC-15)."""
    return records.select(
        F.concat(F.lit("TA-"), "record_id").alias("source_id"), F.format_string("Title: %s\nAbstract: %s\n", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit(""))).alias("text")
    )


# ---- writers


def spark_table(evidence: DataFrame, folder: Path) -> DataFrame:
    """What was written, so that it isn't computed again."""
    return evidence.sparkSession.read.parquet(str(folder / "evidence.parquet"))


def write_table(df: DataFrame, path: str, order: list[str]) -> None:
    """Parquet sorted by ``order`` inside range partitions; an existing path is an error."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)


def write_one_csv(df: DataFrame, path: Path, order: list[str]) -> None:
    """One CSV file with a header, as contracts with people ask for (SNK-1 to SNK-3, SNK-7). Written by one task."""
    if path.exists():
        raise ValueError("the output exists; choose a new one")
    part = path.with_name("." + path.name + ".parts")
    df.orderBy(*order).coalesce(1).write.mode("errorifexists").option("header", True).option("escape", '"').option("emptyValue", "").option("lineSep", "\n").csv(str(part))
    written = sorted(part.glob("*.csv"))
    path.parent.mkdir(parents=True, exist_ok=True)
    if written:
        shutil.move(str(written[0]), path)
    else:
        path.write_text(",".join(df.columns) + "\n", encoding="utf-8")
    shutil.rmtree(part)


def write_screening(decisions: DataFrame, folder: Path, input_file: Path, evidence: DataFrame | None = None) -> dict:
    """decisions.csv, the reasons and the evidence as tables, evidence.json with one record a line, and summary.json with the hash
    of what was read (SNK-2)."""
    if folder.exists():
        raise ValueError("the output exists; choose a new one")
    folder.mkdir(parents=True)
    write_one_csv(decisions.drop("criteria"), folder / "decisions.csv", ["record_id"])
    decisions.select("record_id", "criteria").write.parquet(str(folder / "criteria.parquet"))
    if evidence is not None:
        evidence.write.parquet(str(folder / "evidence.parquet"))
        by = spark_table(evidence, folder).groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct("criterion", "supported", "reason", "evidence"))).alias("criteria"))
        by.repartitionByRange("record_id").sortWithinPartitions("record_id").write.json(str(folder / "evidence.json"))
    counts = {r["decision"]: r["n"] for r in decisions.groupBy("decision").agg(F.count("*").alias("n")).collect()}
    version = decisions.select("rules_version").first()
    out = {"rules_version": version[0] if version else None, "input_file": input_file.name, "input_sha256": digest(input_file), "records": sum(counts.values()), "decisions": counts}
    write_new(folder / "summary.json", jsonx.pretty(out))
    return out


def write_bundle(results: dict[str, list], folder: Path) -> dict:
    """One JSON file a result and a manifest of them, read again and compared (SNK-6)."""
    from evspark.operators.provenance import freeze, verify

    if folder.exists():
        raise ValueError("the output exists; choose a new one")
    for name, value in results.items():
        write_new(folder / "results" / f"{name}.json", jsonx.pretty(value))
    recorded = freeze(folder, [], ["results"], "MANIFEST.json")
    if problems := verify(folder, recorded):
        raise ValueError(f"written files differ: {problems}")
    return recorded
