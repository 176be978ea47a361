"""Rows that fail to parse (problem 7): load the good CSV lines, set the others apart with the reason.

Lines come one per row of a table, already cut. Each batch of lines goes through pyarrow:

1. a grammar of quoting is matched against every line, because one open quote would swallow the lines after it;
2. the other lines are parsed as one CSV buffer with every field a string; the parser's callback for invalid rows
   collects the lines with a wrong number of fields;
3. the columns of what was parsed are matched and cast as vectors, and the first failing cell labels its line. Loaded rows
   have the types of their table: a year is a number, an empty one NULL.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.runtime import table

#: Fixed formats of the two tables.
RECORD_ID = r"^(?:PM[0-9]+|WOS[A-Za-z0-9]+|[A-Z]+-[0-9A-Fa-f]{10})(?:-[0-9]+)?$"
YEAR = r"^(?:[0-9]{4})?$"
STATUS = r"^(?:kept|duplicate|removed_doc_type)$"
INPUT_FILE = r"^search/raw/[^/]+/[^/]+\.(?:txt|ris)$"


@dataclass(frozen=True)
class Layout:
    """Columns of a table in the order of the file, the pattern that the values of some must match, and the type of those that
    are no strings. An empty value of such a column is NULL."""

    columns: tuple[str, ...]
    patterns: dict[str, str] = field(default_factory=dict)
    types: dict[str, pa.DataType] = field(default_factory=dict)

    def type_of(self, column: str) -> pa.DataType:
        return self.types.get(column, pa.string())


LAYOUTS = {
    "ledger": Layout(
        ("record_id", "source", "group_id", "status", "rule", "matched_to", "doc_types", "year", "title", "input_file"),
        {"record_id": RECORD_ID, "year": YEAR, "status": STATUS, "input_file": INPUT_FILE}, {"year": pa.int32()},
    ),
    "records": Layout(
        ("record_id", "title", "abstract", "source", "pmid", "doi", "year", "first_author", "journal", "language",
         "doc_types", "also_found_as", "abstract_from"),
        {"record_id": RECORD_ID, "year": YEAR}, {"year": pa.int32()},
    ),
}

_FIELD = r'(?:"(?:[^"]|"")*"|[^",]*)'
_ONE_LINE_FIELD = r'(?:"(?:[^"]|"")*"|[^",\r\n]*)'
QUOTED_WELL = rf"^(?s:{_FIELD}(?:,{_FIELD})*)$"
ONE_LINE = rf"^(?s:{_ONE_LINE_FIELD}(?:,{_ONE_LINE_FIELD})*)$"
#: Put in front of each line, with its number: the parser can begin a row in the middle of no line.
MARK = "\x1e"


def _castable(values: pa.Array, kind: pa.DataType) -> pa.Array:
    """Which strings are empty or become ``kind``: all at once, and one by one only if some do not."""
    try:
        cast_column(values, kind)
        return pa.array([True] * len(values))
    except pa.ArrowInvalid:
        ok = []
        for text in values.to_pylist():
            try:
                cast_column(pa.array([text]), kind)
                ok.append(True)
            except pa.ArrowInvalid:
                ok.append(False)
        return pa.array(ok)


def cast_column(values: pa.Array, kind: pa.DataType) -> pa.Array:
    return values if kind == pa.string() else pc.cast(pc.if_else(pc.equal(values, ""), pa.scalar(None, pa.string()), values), kind)


def _parse(lines: pa.Array, layout: Layout) -> tuple[list[str | None], list[str | None], list[list[str] | None]]:
    """Of each line the reason why it does not load, the column that is at fault, and its fields if it loads."""
    n = len(lines)
    reasons: list[str | None] = [None] * n
    cells: list[str | None] = [None] * n
    fields: list[list[str] | None] = [None] * n
    well = pc.match_substring_regex(lines, QUOTED_WELL).to_pylist()
    flat = pc.match_substring_regex(lines, ONE_LINE).to_pylist()
    text = lines.to_pylist()
    good = []
    for i in range(n):
        if not well[i]:
            reasons[i] = "quoting"
        elif not flat[i]:
            reasons[i] = "columns"  # a line break outside quotes: these are two rows, of which neither is the line
        else:
            good.append(i)
    if not good:
        return reasons, cells, fields

    def wrong(row) -> str:
        reasons[int(row.text.partition(",")[0].lstrip(MARK))] = "columns"
        return "skip"

    names = ["", *layout.columns]
    data = "".join(f"{MARK}{i},{text[i]}\n" for i in good).encode()
    parsed = pacsv.read_csv(
        io.BytesIO(data),
        read_options=pacsv.ReadOptions(column_names=names, block_size=len(data) + 1, use_threads=False),
        parse_options=pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=wrong),
        convert_options=pacsv.ConvertOptions(column_types={c: pa.string() for c in names}, strings_can_be_null=False),
    )
    if not parsed.num_rows:
        return reasons, cells, fields
    at = [int(x.lstrip(MARK)) for x in parsed.column(0).to_pylist()]
    fault = pa.array([None] * parsed.num_rows, pa.string())
    for name in layout.columns:  # the first cell that fails names its line
        values = parsed.column(name).combine_chunks()
        fits = pc.match_substring_regex(values, layout.patterns[name]) if name in layout.patterns else None
        if name in layout.types:
            cast = _castable(values if fits is None else pc.if_else(fits, values, ""), layout.types[name])
            fits = cast if fits is None else pc.and_(fits, cast)
        if fits is not None:
            fault = pc.if_else(pc.or_(pc.is_valid(fault), fits), fault, name)
    columns = [parsed.column(c).to_pylist() for c in layout.columns]
    for k, (i, cell) in enumerate(zip(at, fault.to_pylist(), strict=True)):
        if cell is None:
            fields[i] = [c[k] for c in columns]
        else:
            reasons[i], cells[i] = "value", cell
    return reasons, cells, fields


_OUT = pa.schema([("raw_id", pa.int64()), ("target", pa.string()), ("reason", pa.string()), ("cell", pa.string()), ("fields", pa.list_(pa.string()))])


def _trimmed(batch: pa.RecordBatch) -> pa.Array:
    return pc.utf8_trim(pc.fill_null(batch.column("raw_line"), ""), "\ufeff\r\n")


def _batches(batches):
    for batch in batches:
        lines = _trimmed(batch)
        target = batch.column("target").to_pylist()
        reasons: list[str | None] = ["columns"] * len(target)  # no such table: no number of fields fits
        cells: list[str | None] = [None] * len(target)
        fields: list[list[str] | None] = [None] * len(target)
        for name in sorted({t for t in target if t in LAYOUTS}):
            rows = [i for i, t in enumerate(target) if t == name]
            for i, r, c, f in zip(rows, *_parse(lines.take(pa.array(rows)), LAYOUTS[name]), strict=True):
                reasons[i], cells[i], fields[i] = r, c, f
        yield pa.RecordBatch.from_arrays(
            [batch.column("raw_id"), batch.column("target"), pa.array(reasons, pa.string()), pa.array(cells, pa.string()), pa.array(fields, pa.list_(pa.string()))],
            schema=_OUT,
        )


def parse_rows(raw: DataFrame) -> DataFrame:
    """(raw_id, target, reason, cell, fields): every line, with its fields, or with the reason why it does not load.

    ``reason`` is the first that applies of quoting, columns and value, NULL for a line that loads; ``cell`` is the first
    column whose value does not fit, if that is the reason. A NULL or empty
    line has one field, so the reason is columns, as for a line of an unknown table. Lines are read alone: a line
    spoils no other. Columns of ``raw`` other than raw_id, target and raw_line are ignored.
    """
    narrow = raw.select(F.col("raw_id").cast("long").alias("raw_id"), F.trim("target").alias("target"), "raw_line")
    return narrow.mapInArrow(_batches, "raw_id long, target string, reason string, cell string, fields array<string>")


def rejects(raw: DataFrame) -> DataFrame:
    return parse_rows(raw).where("reason IS NOT NULL").select("raw_id", "reason")


def load(raw: DataFrame, target: str) -> DataFrame:
    """The valid rows of one table under its column names, with its types."""
    layout = LAYOUTS[target]

    def run(batches):
        for batch in batches:
            reasons, _, fields = _parse(_trimmed(batch), layout)
            good = [i for i, r in enumerate(reasons) if r is None]
            columns = [cast_column(pa.array([fields[i][k] for i in good], pa.string()), layout.type_of(c)) for k, c in enumerate(layout.columns)]
            yield pa.RecordBatch.from_arrays([batch.column("raw_id").take(pa.array(good, pa.int64())), *columns], ["raw_id", *layout.columns])

    sql = {"int32": "int", "string": "string"}
    schema = ", ".join(["raw_id long", *[f"{c} {sql[str(layout.type_of(c))]}" for c in layout.columns]])
    return raw.where(F.trim("target") == target).select(F.col("raw_id").cast("long").alias("raw_id"), "raw_line").mapInArrow(run, schema)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(table(spark, sf_dir, "raw_rows"))


def p7_loaded_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(table(spark, sf_dir, "raw_rows"), "ledger")


QUERIES = {"p7_found": p7_found, "p7_loaded_ledger": p7_loaded_ledger}

_LINES = r"""t AS (SELECT raw_id, target, trim(coalesce(raw_line, ''), chr(65279) || chr(13) || chr(10)) AS s FROM raw_rows),
g AS (
  SELECT *, regexp_full_match(s, '(?s)(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*') AS well,
    regexp_replace(s, '(?s)"(?:[^"]|"")*"', 'Q', 'g') AS bare,
    list_transform(regexp_extract_all(',' || s, '(?s),(?:"(?:[^"]|"")*"|[^",]*)'),
      lambda x: CASE WHEN x LIKE ',"%' THEN replace(x[3:-2], '""', '"') ELSE x[2:] END) AS f FROM t),
c AS (
  SELECT *, len(f) <> CASE target WHEN 'ledger' THEN 10 ELSE 13 END OR regexp_matches(bare, '[\r\n]') AS odd FROM g),
r AS (
  SELECT raw_id, target, f, CASE WHEN NOT well THEN 'quoting' WHEN odd THEN 'columns' WHEN
  NOT regexp_full_match(f[1], '(?:PM[0-9]+|WOS[A-Za-z0-9]+|[A-Z]+-[0-9A-Fa-f]{10})(?:-[0-9]+)?')
  OR NOT regexp_full_match(CASE target WHEN 'ledger' THEN f[8] ELSE f[7] END, '(?:[0-9]{4})?')
  OR (target = 'ledger' AND (f[4] NOT IN ('kept', 'duplicate', 'removed_doc_type')
    OR NOT regexp_full_match(f[10], 'search/raw/[^/]+/[^/]+\.(?:txt|ris)'))) THEN 'value' END AS reason FROM c)"""

ORACLE = {
    "p7_found": f"WITH {_LINES} SELECT raw_id, reason FROM r WHERE reason IS NOT NULL",
    "p7_loaded_ledger": f"""WITH {_LINES} SELECT raw_id, f[1] AS record_id, f[2] AS source, f[3] AS group_id, f[4] AS status, f[5] AS rule, f[6] AS matched_to,
  f[7] AS doc_types, TRY_CAST(nullif(f[8], '') AS INTEGER) AS year, f[9] AS title, f[10] AS input_file FROM r WHERE target = 'ledger' AND reason IS NULL""",
}
