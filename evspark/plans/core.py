"""Queries of the project's own operators over the test tables, with SQL that gives the same rows.

Where SQL cannot say what an operator does (ordered merges, Ratcliff-Obershelp ratios) there is none; tests hold the
operator against a model instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.functions import sqlfunctions, stats, text
from evspark.functions.jsonx import strict_json
from evspark.operators import answers, audit, codebook, effects, evidence, linkage, lookup, provenance, registry, screening
from evspark.operators.components import components
from evspark.runtime import numbered, table
from evspark.sources import exports
from evspark.plans import flow as flows
from evspark.streaming import attempts

L, D = "long", "double"
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _rec(spark: SparkSession, d: str) -> DataFrame:
    """Records as the linkage takes them, yet without their order."""
    r = table(spark, d, "records")
    missing = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return r.select(
        "record_id", F.lower(F.trim("source")).alias("source"), F.lit("").alias("input_file"),
        *map(missing, ("pmid", "doi", "title", "abstract", "year", "first_author", "journal", "language")),
        F.filter(F.transform(F.split(F.coalesce("doc_types", F.lit("")), ";"), lambda t: F.trim(t)), lambda t: t != "").alias("doc_types"),
    )


def _ordered(spark: SparkSession, d: str) -> DataFrame:
    """In the order of their ids."""
    return numbered(_rec(spark, d), "ord", "record_id")


#: The same columns in SQL. FOLD is exact for what small letters and accents of Latin scripts give.
_REC = """rec AS (SELECT record_id, lower(trim(source)) AS source, coalesce(pmid, '') AS pmid, coalesce(doi, '') AS doi, coalesce(title, '') AS title,
  coalesce(abstract, '') AS abstract, coalesce(year, '') AS year, coalesce(first_author, '') AS first_author FROM records)"""
_KEY = "trim(regexp_replace(lower(trim(regexp_replace(regexp_replace({c}, '[^\\x00-\\x7F]+', ' ', 'g'), '\\s+', ' ', 'g'))), '[^a-z0-9]+', ' ', 'g'))"


def _ascii_key(c):
    """Letters and digits of the ASCII part: a key both engines agree on for any text."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\x00-\x7F]+", " ")), "[^a-z0-9]+", " "))


# ---- functions


@query(r"""SELECT doc_id, trim(regexp_replace(lower(strip_accents(replace(replace(replace(replace(coalesce(text, ''),
  '…', '...'), 'º', 'o'), 'ª', 'a'), '²', '2'))), '[^a-z0-9]+', ' ', 'g')) AS ntitle FROM documents""")
def norm_title(spark, d):
    return table(spark, d, "documents").select("doc_id", text.norm_text(F.coalesce("text", F.lit(""))).alias("ntitle"))


@query(r"""SELECT record_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(doi, ''))),
  '^https://doi\.org/', ''), '^http://doi\.org/', ''), '^https://dx\.doi\.org/', ''), '^http://dx\.doi\.org/', ''), '^doi:', '')) AS ndoi FROM records""")
def norm_doi(spark, d):
    return table(spark, d, "records").select("record_id", text.norm_doi(F.col("doi")).alias("ndoi"))


@query("""SELECT record_id, CASE WHEN contains(coalesce(first_author, ''), ',') THEN split_part(first_author, ',', 1) ELSE split_part(coalesce(first_author, ''), ' ', 1) END AS surname,
  CAST(len(list_filter(string_split(trim(regexp_replace(lower(regexp_replace(coalesce(title, ''), '[^\\x00-\\x7F]+', ' ', 'g')), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '')) AS BIGINT) AS n_words,
  regexp_extract(coalesce(year, ''), '[0-9]{4}') AS year FROM records""".replace("\\\\", "\\"))
def records_view(spark, d):
    r = table(spark, d, "records")
    return r.select(
        "record_id", text.surname(F.col("first_author")).alias("surname"), text.count_words(_ascii_key(F.col("title"))).alias("n_words"),
        F.regexp_extract(F.coalesce("year", F.lit("")), "[0-9]{4}", 0).alias("year"),
    )


# ---- exports: rendered, then parsed


def _joined(*parts) -> F.Column:
    return F.concat_ws("\n", *[F.concat(F.lit(p[0]), p[1]) if isinstance(p, tuple) else F.lit(p) for p in parts])


def _files(df: DataFrame, body, name: str) -> DataFrame:
    """Rendered records as files of some five hundred records each, whatever their number."""
    n = df.count() // 500 + 1
    rows = df.select(F.pmod(F.xxhash64(df.columns[0]), F.lit(n)).alias("f"), F.struct(F.col(df.columns[0]).alias("k"), body.alias("b")).alias("r"))
    text_ = F.array_join(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["b"]), "\n")
    return rows.groupBy("f").agg(text_.alias("text")).select(F.concat(F.lit(f"x/{name}_"), F.col("f").cast("string"), F.lit(".txt")).alias("file"), "text")


@query("""SELECT 'PM' || p_partkey AS record_id, p_name AS title, CAST(1950 + p_size AS VARCHAR) AS year, p_brand AS first_author, p_type || '; ' || p_brand AS doc_types,
  '10.5555/p' || p_partkey AS doi FROM part""")
def medline_roundtrip(spark, d):
    p = table(spark, d, "part").select("p_partkey", *["p_name", "p_brand", "p_type", "p_size"])
    body = _joined(
        ("PMID- ", F.col("p_partkey").cast("string")), ("TI  - ", F.substring_index("p_name", " ", 1)), ("      ", F.substring(F.col("p_name"), F.length(F.substring_index("p_name", " ", 1)) + 2, F.length("p_name"))),
        ("DP  - ", F.concat((F.col("p_size") + 1950).cast("string"), F.lit(" Jan"))), ("FAU - ", F.concat("p_brand", F.lit(", X"))), ("PT  - ", F.col("p_type")), ("PT  - ", F.col("p_brand")),
        ("LID - ", F.concat(F.lit("10.5555/p"), F.col("p_partkey").cast("string"), F.lit(" [doi]"))), "",
    )
    out = exports.parse(_files(p, body, "pubmed"))
    return out.select("record_id", "title", "year", "first_author", F.array_join("doc_types", "; ").alias("doc_types"), "doi")


@query("""SELECT 'WOS' || replace(s_name, '#', '') || s_suppkey AS record_id, s_name || ' of ' || n_name AS title, n_name AS journal, CAST(1990 + s_nationkey AS VARCHAR) AS year, 'Article; Letter' AS doc_types
  FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def wos_roundtrip(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name", "s_nationkey")
    body = _joined(
        "PT J", ("TI ", F.col("s_name")), ("   of ", F.col("n_name")), ("SO ", F.col("n_name")), "DT Article; Letter",
        ("EA JAN ", (F.col("s_nationkey") + 1990).cast("string")), ("UT WOS:", F.concat(F.regexp_replace("s_name", "#", ""), F.col("s_suppkey").cast("string"))), "ER", "",
    )
    out = exports.parse(_files(s, body, "wos"))
    return out.select(F.regexp_replace("record_id", "^WOS", "WOS").alias("record_id"), "title", "journal", "year", F.array_join("doc_types", "; ").alias("doc_types"))


@query("""SELECT c_name AS title, c_mktsegment AS journal, CAST(2000 + c_nationkey AS VARCHAR) AS year, '10.5555/c' || c_custkey AS doi,
  'RIS_' || 'X' AS kind FROM customer""")
def ris_roundtrip(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    body = _joined(
        "TY  - JOUR", ("TI  - ", F.col("c_name")), ("PY  - ", (F.col("c_nationkey") + 2000).cast("string")), ("UR  - https://x.example/10.5555/c", F.col("c_custkey").cast("string")),
        ("JF  - ", F.col("c_mktsegment")), "ER  - ", "",
    )
    out = exports.parse(_files(c, body, "ris"))
    return out.select("title", "journal", "year", "doi", F.lit("RIS_X").alias("kind"))


@query("""SELECT kind, count(*) AS n FROM (SELECT CASE p_size % 4 WHEN 0 THEN 'medline' WHEN 1 THEN 'wos' WHEN 2 THEN 'ris' ELSE 'none' END AS kind FROM part) GROUP BY kind""")
def sniff_format(spark, d):
    k = F.pmod(F.col("p_size"), F.lit(4))
    body = F.when(k == 0, F.concat(F.lit("\nPMID- "), "p_name")).when(k == 1, F.concat(F.lit("PT J\nUT "), "p_name", F.lit("\nER \n"))).when(k == 2, F.concat(F.lit("TY  - JOUR\nTI  - "), "p_name")).otherwise(F.col("p_name"))
    return table(spark, d, "part").select(F.coalesce(exports.sniff(body), F.lit("none")).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("""SELECT event_id, CASE WHEN k > 1 THEN base || '-' || k ELSE base END AS id FROM (
  SELECT event_id, event_type || user_id AS base, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS k FROM events)""")
def running_suffix_ids(spark, d):
    e = table(spark, d, "events").withColumn("base", F.concat("event_type", F.col("user_id").cast("string")))
    return e.select("event_id", exports.suffixed("base", "ts", "event_id").alias("id"))


@query("""SELECT p_partkey, p_type GLOB '*STEEL' OR p_type GLOB 'PROMO*' OR p_type GLOB '[ES]*?TIN' AS removable FROM part""")
def glob_removable(spark, d):
    return table(spark, d, "part").select("p_partkey", text.any_glob(F.col("p_type"), ["*STEEL", "PROMO*", "[ES]*?TIN"]).alias("removable"))


# ---- linkage


@query(f"""WITH k AS (SELECT record_id, {_KEY.format(c="coalesce(title, '')")} AS nt, 2000 + length(coalesce(abstract, '')) % 20 AS y FROM records)
SELECT least(a.record_id, b.record_id) AS id_a, greatest(a.record_id, b.record_id) AS id_b FROM k a JOIN k b ON a.nt = b.nt AND b.y - a.y = 1 WHERE len(string_split(a.nt, ' ')) >= 6""")
def r1_pairs(spark, d):
    """Equal titles with years one apart; the years come from the lengths of the abstracts."""
    year = (F.length(F.coalesce("abstract", F.lit(""))) % 20 + 2000).cast("string")
    r = table(spark, d, "records").select(F.col("record_id").alias("ord"), _ascii_key(F.col("title")).alias("ntitle"), year.alias("year"))
    pairs = linkage.years_apart(r.withColumn("long", text.count_words(F.col("ntitle")) >= 6))
    return pairs.select(F.col("ord_a").alias("id_a"), F.col("ord_b").alias("id_b"))


RULES = linkage.Rules(source_precedence=("pubmed", "wos"), listed={"default": ("Editorial", "Letter")}, neutral={"default": ("Journal Article",)})


def _keyed_by(spark, d, *keys: str) -> DataFrame:
    """All records with these keys only, so that one rule decides all; titles by their ASCII letters, which both engines fold
    alike. What a record is called by, and what it is, stays."""
    empty = {c: F.lit("") for c in ("pmid", "doi", "title", "first_author") if c not in keys}
    own = {"title": _ascii_key(F.col("title"))} if "title" in keys else {}
    return _ordered(spark, d).withColumns(empty | own)


#: The ledger of a linkage by one key: {key} is the SQL of the key, NULL if there is none; {title} the title that is kept.
_LEDGER = """rec AS (SELECT record_id, lower(trim(source)) AS source, coalesce(pmid, '') AS pmid, coalesce(doi, '') AS doi, coalesce(title, '') AS title, coalesce(abstract, '') AS abstract,
    coalesce(year, '') AS year, list_filter(list_transform(string_split(coalesce(doc_types, ''), ';'), lambda x: trim(x)), lambda x: x <> '') AS types FROM records),
  k AS (SELECT *, {key} AS key FROM rec),
  g AS (SELECT *, coalesce('k' || key, 'r' || record_id) AS root, CASE source WHEN 'pubmed' THEN 1 WHEN 'wos' THEN 2 ELSE 3 END AS p,
    len(list_filter(types, lambda x: x IN ('Editorial', 'Letter'))) > 0 AND len(list_filter(types, lambda x: x NOT IN ('Editorial', 'Letter', 'Journal Article'))) = 0 AS off FROM k),
  o AS (SELECT *, first_value(record_id) OVER (PARTITION BY root ORDER BY p, CASE WHEN p < 3 THEN '' ELSE source END, abstract = '', record_id) AS best,
    bool_and(off) OVER (PARTITION BY root) AS drop_, row_number() OVER (PARTITION BY root ORDER BY record_id) AS i,
    first_value(record_id) OVER (PARTITION BY root ORDER BY record_id) AS head, nth_value(record_id, 2) OVER (PARTITION BY root ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM g),
  l AS (SELECT *, CASE WHEN record_id <> best THEN 'duplicate' WHEN drop_ THEN 'removed_doc_type' ELSE 'kept' END AS status FROM o)"""
_LEDGER_ROWS = """SELECT record_id, source, best AS group_id, status, CASE status WHEN 'duplicate' THEN '{rule}' WHEN 'removed_doc_type' THEN 'DT' ELSE '' END AS rule,
  CASE WHEN status <> 'duplicate' THEN '' WHEN i = 1 THEN second ELSE head END AS matched_to, array_to_string(types, '; ') AS doc_types, year, {title} AS title FROM l"""
_DOI_KEY = "nullif(" + r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(doi)), '^https://doi\.org/', ''), '^http://doi\.org/', ''), '^https://dx\.doi\.org/', ''),
  '^http://dx\.doi\.org/', ''), '^doi:', ''))""".replace("\\\\", "\\") + ", '')"
_TITLE = _KEY.format(c="title")
#: Long titles of one year, apart by whether the record is a report version.
_TITLE_KEY = f"CASE WHEN len(string_split({_TITLE}, ' ')) >= 6 AND {_TITLE} <> '' AND year <> '' THEN {_TITLE} || '|' || year || '|' || (len(list_filter(types, lambda x: x IN ('Preprint', 'UNPB'))) > 0) END"


def _ledger_of(key: str, rule: str, title: str) -> str:
    return f"WITH {_LEDGER.format(key=key)} {_LEDGER_ROWS.format(rule=rule, title=title)}"


@query(_ledger_of("nullif(pmid, '')", "M1", "''"))
def dedup_by_pmid(spark, d):
    """Rule M1 alone on all records: groups, survivors, removal by document types, ledger."""
    return linkage.link(_keyed_by(spark, d, "pmid"), RULES).ledger.drop("input_file")


@query(_ledger_of(_DOI_KEY, "M2", "''"))
def dedup_by_doi(spark, d):
    return linkage.link(_keyed_by(spark, d, "doi"), RULES).ledger.drop("input_file")


@query(_ledger_of(_TITLE_KEY, "M3", _TITLE))
def dedup_by_title(spark, d):
    """Rule M3 alone; of one title and year report versions stay apart from the rest (R4)."""
    return linkage.link(_keyed_by(spark, d, "title"), RULES).ledger.drop("input_file")


@query(f"""WITH {_LEDGER.format(key=_TITLE_KEY)}, c AS (SELECT DISTINCT {_TITLE} AS nt, year, types, key, record_id FROM k WHERE {_TITLE} <> '' AND year <> ''),
  v AS (SELECT DISTINCT nt, year, key FROM c WHERE key IS NOT NULL), w AS (SELECT nt, year, record_id FROM c WHERE key IS NULL)
SELECT 'R1' AS rule, count(*) AS n FROM v a JOIN v b ON a.nt = b.nt AND regexp_full_match(a.year, '[0-9]{{1,9}}') AND regexp_full_match(b.year, '[0-9]{{1,9}}') AND TRY_CAST(b.year AS BIGINT) = TRY_CAST(a.year AS BIGINT) + 1 HAVING count(*) > 0
UNION ALL SELECT 'R2', count(*) FROM w a JOIN w b ON a.nt = b.nt AND a.year = b.year AND a.record_id < b.record_id HAVING count(*) > 0
UNION ALL SELECT 'R4', count(*) FROM v a JOIN v b ON a.nt = b.nt AND a.year = b.year AND a.key < b.key HAVING count(*) > 0""")
def review_by_title(spark, d):
    """Pairs shown to the reader when titles, years and report versions decide, by rule."""
    return linkage.link(_keyed_by(spark, d, "title"), RULES).review.groupBy("rule").agg(F.count("*").alias("n"))


@query(f"""WITH {_LEDGER.format(key="nullif(pmid, '')")}, a AS (SELECT best, string_agg(record_id, '; ' ORDER BY p, CASE WHEN p < 3 THEN '' ELSE source END, abstract = '', record_id) AS others FROM l WHERE status = 'duplicate' GROUP BY best),
  n AS (SELECT best, record_id AS donor, abstract AS lent, row_number() OVER (PARTITION BY best ORDER BY length(abstract) DESC, p, CASE WHEN p < 3 THEN '' ELSE source END, record_id) AS j FROM l WHERE abstract <> '')
SELECT record_id, coalesce(others, '') AS also_found_as, CASE WHEN abstract = '' THEN coalesce(donor, '') ELSE '' END AS abstract_from, CASE WHEN abstract = '' THEN coalesce(length(lent), 0) ELSE length(abstract) END AS abstract_length
FROM l LEFT JOIN a USING (best) LEFT JOIN n ON l.best = n.best AND j = 1 WHERE status = 'kept'""")
def kept_by_pmid(spark, d):
    """Kept records with their other copies and, where they have no abstract, the one of the best copy that has."""
    kept = linkage.link(_keyed_by(spark, d, "pmid"), RULES).kept
    return kept.select("record_id", "also_found_as", "abstract_from", F.length("abstract").cast(L).alias("abstract_length"))


@query("""WITH RECURSIVE n AS (SELECT count(*) AS n FROM records), l AS (SELECT DISTINCT trim(record_id_a) AS u, trim(record_id_b) AS v FROM review_pairs
  WHERE lower(trim(decision)) = 'duplicate' AND trim(record_id_a) IN (SELECT record_id FROM records) AND trim(record_id_b) IN (SELECT record_id FROM records) AND trim(record_id_a) <> trim(record_id_b)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l), walk AS (SELECT u AS id, u AS seen FROM e UNION SELECT w.id, e.v FROM walk w JOIN e ON w.seen = e.u), r AS (SELECT id, min(seen) AS root FROM walk GROUP BY id)
SELECT n AS records_identified, count(*) - count(DISTINCT root) AS duplicates_removed, count(*) - count(DISTINCT root) AS duplicates_d, n - (count(*) - count(DISTINCT root)) AS records_passed_to_screening, true AS balanced FROM r, n GROUP BY n""")
def dedup_by_decision(spark, d):
    """Rule D alone: all decided pairs of the table, in the order of their ids; ids without a record decide nothing."""
    records = _keyed_by(spark, d)
    pairs = table(spark, d, "review_pairs").where("lower(trim(decision)) = 'duplicate'").select(
        "pair_id", F.trim("record_id_a").alias("record_id_a"), F.trim("record_id_b").alias("record_id_b"), F.lit("duplicate").alias("decision"), F.lit("").alias("note")
    )
    counts = linkage.link(records, linkage.Rules(), numbered(pairs, "decision_ord", "pair_id")).counts
    return counts.select("records_identified", "duplicates_removed", "duplicates_d", "records_passed_to_screening", "balanced")


@query()
def dedup_ledger(spark, d):
    return linkage.link(_ordered(spark, d), RULES).ledger


@query()
def dedup_counts(spark, d):
    return linkage.link(_ordered(spark, d), linkage.Rules()).counts


@query()
def r3_similar(spark, d):
    r = _ordered(spark, d).select("ord", text.norm_text(F.col("title")).alias("ntitle"), text.norm_text(F.col("first_author")).alias("nauthor"), "year", F.col("ord").alias("root"))
    found = linkage.similar_titles(r.where("nauthor <> '' AND year <> '' AND ntitle <> ''"), 0.9, ["nauthor", "year"])
    return found.select("ord_a", "ord_b", F.round("ratio", 3).alias("similarity"))


@query("""WITH RECURSIVE l AS (SELECT trim(record_id_a) AS u, trim(record_id_b) AS v FROM review_pairs WHERE trim(record_id_a) <> trim(record_id_b)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l), walk AS (SELECT u AS id, u AS seen FROM e UNION SELECT w.id, e.v FROM walk w JOIN e ON w.seen = e.u)
SELECT id, min(seen) AS first_id FROM walk GROUP BY id""")
def component_labels(spark, d):
    links = table(spark, d, "review_pairs").select(F.trim("record_id_a").alias("u"), F.trim("record_id_b").alias("v"))
    return components(links).select("id", F.col("group").alias("first_id"))


# ---- screening

CRITERIA = [
    screening.Criterion("C1", "intervention", any_of=("training", "coaching", "reading"), any_of_regex=(r"pract(?:ice|ise)",)),
    screening.Criterion("C2", "original", none_of=("editorial", "commentary on"), title_none_of=("reply to the letter",)),
    screening.Criterion("C3", "language", field="language", field_any_of=("en", "eng", "english")),
    screening.Criterion("C4", "full text only", any_of=("n",), check_at=("ft",)),
]
_SCREEN = r"""t AS (
  SELECT record_id, coalesce(language, '') AS language, coalesce(abstract, '') AS abstract,
    lower(trim(regexp_replace(translate(coalesce(title, '') || ' ' || coalesce(abstract, ''), '’‘', ''''''), '[\s\p{Z}\x1c-\x1f\x85]+', ' ', 'g'))) AS x,
    lower(trim(regexp_replace(translate(coalesce(title, ''), '’‘', ''''''), '[\s\p{Z}\x1c-\x1f\x85]+', ' ', 'g'))) AS h,
    lower(trim(regexp_replace(translate(coalesce(language, ''), '’‘', ''''''), '[\s\p{Z}\x1c-\x1f\x85]+', ' ', 'g'))) AS l FROM records),
c AS (
  SELECT record_id, trim(abstract) = '' AS blank,
    regexp_matches(x, '(^|[^a-z0-9])(training|coaching|reading)([^a-z0-9]|$)') OR regexp_matches(x, 'pract(?:ice|ise)') AS c1,
    NOT (regexp_matches(x, '(^|[^a-z0-9])(editorial|commentary on)([^a-z0-9]|$)') OR regexp_matches(h, '(^|[^a-z0-9])reply to the letter([^a-z0-9]|$)')) AS c2,
    l = '' OR regexp_matches(l, '(^|[^a-z0-9])(en|eng|english)([^a-z0-9]|$)') AS c3 FROM t),
s AS (
  SELECT record_id, CASE WHEN blank OR (c1 AND c2 AND c3) THEN 'keep' ELSE 'exclude' END AS decision,
    CASE WHEN blank THEN '' ELSE array_to_string(list_filter([CASE WHEN NOT c1 THEN 'C1' END, CASE WHEN NOT c2 THEN 'C2' END, CASE WHEN NOT c3 THEN 'C3' END], lambda z: z IS NOT NULL), ';') END AS failed_criteria,
    blank FROM c)"""


@query(f"""WITH {_SCREEN} SELECT record_id, decision, failed_criteria, CASE WHEN blank THEN 'no abstract: kept for full-text screening'
  WHEN failed_criteria <> '' THEN 'failed ' || replace(failed_criteria, ';', ', ') ELSE 'all checked criteria supported' END AS reason FROM s""")
def screen_ta(spark, d):
    return screening.screen(table(spark, d, "records"), CRITERIA, "ta", "1").select("record_id", "decision", "failed_criteria", "reason")


@query(f"WITH {_SCREEN} SELECT decision, failed_criteria, count(*) AS n FROM s GROUP BY decision, failed_criteria")
def screen_counts(spark, d):
    out = screening.screen(table(spark, d, "records"), CRITERIA, "ta", "1")
    return out.groupBy("decision", "failed_criteria").agg(F.count("*").alias("n"))


@query(f"WITH {_SCREEN} SELECT record_id, failed_criteria FROM s WHERE failed_criteria IN ('C1', 'C2', 'C3')")
def near_miss(spark, d):
    return screening.near_misses(screening.screen(table(spark, d, "records"), CRITERIA, "ta", "1")).select("record_id", "failed_criteria")


@query(r"""WITH t AS (SELECT record_id, lower(trim(regexp_replace(translate(coalesce(title, '') || ' ' || coalesce(abstract, ''), '’‘', ''''''), '[\s\p{Z}\x1c-\x1f\x85]+', ' ', 'g'))) AS x FROM records),
p AS (SELECT record_id, x, CASE WHEN regexp_matches(x, '^training([^a-z0-9]|$)') THEN 1 ELSE length(regexp_extract(x, '^(.*?[^a-z0-9])training([^a-z0-9]|$)', 1)) + 1 END AS i FROM t WHERE regexp_matches(x, '(^|[^a-z0-9])training([^a-z0-9]|$)'))
SELECT record_id, substr(x, greatest(1, i - 60)::BIGINT, (i - greatest(1, i - 60) + 68)::BIGINT) AS snippet FROM p""")
def screen_evidence_first(spark, d):
    r = table(spark, d, "records")
    x = text.screening_text(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit(""))))
    return r.select("record_id", x.alias("x")).select("record_id", text.first_snippet(F.col("x"), "training").alias("snippet")).where("snippet IS NOT NULL")


@query()
def screen_evidence(spark, d):
    found = screening.evidence(table(spark, d, "records"), CRITERIA, "ta")
    return found.select("record_id", "criterion", "supported", "reason", F.array_join(F.transform("evidence", lambda e: F.concat_ws(": ", e["term"], e["snippet"])), " | ").alias("evidence"))


@query(f"""WITH {_SCREEN}, l AS (SELECT DISTINCT trim(record_id) AS record_id FROM ledger WHERE status = 'duplicate')
SELECT record_id FROM s WHERE decision = 'keep' AND record_id NOT IN (SELECT record_id FROM l WHERE record_id IS NOT NULL)""")
def ft_input(spark, d):
    r = table(spark, d, "records")
    decided = screening.screen(r, CRITERIA, "ta", "1")
    gone = table(spark, d, "ledger").where("status = 'duplicate'").select(F.trim("record_id").alias("record_id")).distinct()
    return screening.full_text_input(r, decided, r.select("record_id").limit(0), gone).select("record_id")


@query("""WITH a AS (SELECT DISTINCT record_id FROM records), b AS (SELECT DISTINCT trim(record_id) AS record_id FROM ledger WHERE record_id IS NOT NULL AND status = 'kept')
SELECT record_id, 'undecided' AS side FROM a WHERE record_id NOT IN (SELECT record_id FROM b) UNION ALL SELECT record_id, 'unknown' FROM b WHERE record_id NOT IN (SELECT record_id FROM a)""")
def coverage_diff(spark, d):
    return screening.coverage_gaps(table(spark, d, "records"), table(spark, d, "ledger").where("record_id IS NOT NULL AND status = 'kept'").select(F.trim("record_id").alias("record_id")))


# ---- audits


def _votes(spark, d):
    r = table(spark, d, "records").select(F.col("record_id").alias("source_id"), F.sha2("record_id", 256).alias("h"))
    v = lambda k, who: F.struct(F.lit(who).alias("reviewer"), F.when(F.substring("h", k, 1) < "8", "include").otherwise("exclude").alias("decision"))
    two = r.select("source_id", "h", v(1, "auditor_1").alias("a"), v(2, "auditor_2").alias("b"), v(3, "third").alias("c"))
    return two.select("source_id", F.explode(F.when(F.col("a.decision") == F.col("b.decision"), F.array("a", "b")).otherwise(F.array("a", "b", "c"))).alias("v")).select("source_id", "v.*")


@query("""WITH h AS (SELECT record_id AS source_id, sha256(record_id) AS h FROM records), v AS (
  SELECT source_id, substr(h, 1, 1) < '8' AS a, substr(h, 2, 1) < '8' AS b, substr(h, 3, 1) < '8' AS c FROM h)
SELECT source_id, CASE WHEN (a = b AND a) OR (a <> b AND c) THEN 'include' ELSE 'exclude' END AS majority,
  concat_ws(',', CASE WHEN a THEN 'include' ELSE 'exclude' END, CASE WHEN b THEN 'include' ELSE 'exclude' END, CASE WHEN a <> b THEN CASE WHEN c THEN 'include' ELSE 'exclude' END END) AS votes,
  CASE WHEN (a = b AND a) OR (a <> b AND c) THEN 'human' ELSE 'done' END AS route FROM v""")
def audit_routing(spark, d):
    return audit.routed_votes(_votes(spark, d))


_LOG = """k AS (SELECT request_id, attempt, CASE regexp_replace(lower(trim(kind)), '[\\W_]+', '_', 'g') WHEN 'technical_error' THEN 'TECHNICAL_FAILURE'
  WHEN 'response' THEN CASE WHEN length(coalesce(raw_text, '')) > 60 THEN 'VALID' ELSE 'INVALID_RESPONSE' END END AS status FROM (SELECT DISTINCT request_id, attempt, kind, raw_text FROM responses)),
g AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY attempt) AS k, min(CASE WHEN status = 'VALID' THEN attempt END) OVER (PARTITION BY request_id) AS first FROM k)"""


def _log(spark, d):
    a = table(spark, d, "responses").select("request_id", "attempt", "kind", "raw_text").distinct()
    return audit.attempt_log(a, F.length(F.coalesce("raw_text", F.lit(""))) > 60)


@query(f"""WITH {_LOG} SELECT status, CASE WHEN status IS NULL THEN 'unknown kind' WHEN attempt <> k THEN 'attempts are not 1 to n' WHEN attempt > first THEN 'attempt after a valid one' END AS problem,
  count(*) AS n FROM g GROUP BY ALL""")
def attempt_log(spark, d):
    return _log(spark, d).groupBy("status", "problem").agg(F.count("*").alias("n"))


@query(f"""WITH {_LOG} SELECT request_id, count(*) AS attempts, count(*) FILTER (WHERE status = 'TECHNICAL_FAILURE') AS technical_failures, count(*) FILTER (WHERE status = 'INVALID_RESPONSE') AS invalid,
  CAST(coalesce(min(CASE WHEN status = 'VALID' THEN attempt END), 0) AS BIGINT) AS accepted FROM g GROUP BY request_id""")
def attempts_to_valid(spark, d):
    return audit.resolved(_log(spark, d)).withColumn("accepted", F.coalesce("accepted", F.lit(0)).cast(L))


@query("""WITH a AS (SELECT DISTINCT record_id AS request_id FROM records), b AS (SELECT DISTINCT trim(record_id_a) AS request_id FROM review_pairs WHERE record_id_a IS NOT NULL)
SELECT request_id, 'unused request' AS problem FROM a WHERE request_id NOT IN (SELECT request_id FROM b) UNION ALL SELECT request_id, 'unknown request' FROM b WHERE request_id NOT IN (SELECT request_id FROM a)""")
def request_gaps(spark, d):
    """Records as requests and review pairs as attempts: what was never used, and what nobody asked for."""
    ids = lambda name, c: table(spark, d, name).where(F.col(c).isNotNull()).select(F.trim(c).alias("request_id"))
    return audit.request_gaps(ids("records", "record_id"), ids("review_pairs", "record_id_a"))


@query("""SELECT request_id, sha256(request) = request_sha256 AS sha_ok FROM requests""")
def request_hashes(spark, d):
    return audit.request_identity(table(spark, d, "requests")).select("request_id", "sha_ok")


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY doc_kind ORDER BY sha256('seed-1:' || CAST(doc_id AS VARCHAR)), doc_id) AS place FROM documents)
SELECT doc_kind, doc_id, place FROM s WHERE place BETWEEN 11 AND 20""")
def seeded_sample(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "doc_kind")
    return audit.seeded_sample(docs, "doc_id", ["doc_kind"], "seed-1", 11, 20).select("doc_kind", "doc_id", F.col("place").cast(L).alias("place"))


@query("""SELECT o_orderkey, round(CASE WHEN o_orderkey % 7 = 0 THEN round(o_totalprice + 1, 2) ELSE o_totalprice END, 4) AS o_totalprice,
  CASE WHEN o_orderkey % 11 = 0 THEN 'fixed' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def reconcile(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    price = o.where("o_orderkey % 7 = 0").select("o_orderkey", F.lit("o_totalprice").alias("field"), F.round(F.col("o_totalprice") + 1, 2).cast("string").alias("new"))
    prio = o.where("o_orderkey % 11 = 0").select("o_orderkey", F.lit("o_orderpriority").alias("field"), F.lit("fixed").alias("new"))
    out = audit.reconciled(o, price.unionByName(prio), ["o_totalprice", "o_orderpriority"], "o_orderkey")
    return out.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query("""SELECT outcome, count(*) AS n FROM (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'rejected' WHEN 1 THEN 'correction' ELSE 'needs_human' END AS outcome FROM orders) GROUP BY outcome""")
def challenge_routing(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("Row_UID"), F.lit("x").alias("field"), F.col("o_orderkey").alias("k"))
    challenges = o.select("Row_UID", "field", F.lit("10").alias("current"), F.lit("12.5").alias("proposed"))
    judged = o.select("Row_UID", "field", F.expr("CASE k % 5 WHEN 0 THEN '10.0' WHEN 1 THEN '12.50' WHEN 2 THEN 'true' WHEN 3 THEN NULL ELSE '\"10\"' END").alias("value"))
    return audit.routed_challenges(challenges, judged).groupBy("outcome").agg(F.count("*").alias("n"))


# ---- registry


def _registered(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.select(F.col("s_name").alias("study"), F.col("n_name").alias("arm"), F.col("s_suppkey").alias("k"), "s_acctbal")
    empty = s.sparkSession.createDataFrame([], "row_uid string, identity map<string,string>, status string")
    first = registry.register(s.where("s_acctbal >= 0"), empty, ["study", "arm"], "TEST", "k")
    return s, first


@query("""SELECT 'TEST-R' || lpad(CAST(row_number() OVER (ORDER BY s_acctbal < 0, s_suppkey) AS VARCHAR), 6, '0') AS row_uid, s_name AS study FROM supplier""")
def registry_alloc(spark, d):
    s, first = _registered(spark, d)
    second = registry.register(s, first, ["study", "arm"], "TEST", "k")
    return second.select("row_uid", F.col("identity")["study"].alias("study"))


@query("""WITH r AS (SELECT s_suppkey, s_name, 'TEST-R' || lpad(CAST(row_number() OVER (ORDER BY s_suppkey) AS VARCHAR), 6, '0') AS row_uid FROM supplier WHERE s_acctbal >= 0)
SELECT s.s_name AS study, row_uid, CASE WHEN row_uid IS NULL THEN 'unregistered' WHEN row_uid = 'TEST-R000001' THEN 'retired' END AS problem FROM supplier s LEFT JOIN r USING (s_suppkey)""")
def registry_lookup(spark, d):
    s, first = _registered(spark, d)
    retired = registry.retire(first, spark.createDataFrame([("TEST-R000001",)], "row_uid string"))
    return registry.lookup(s.select("study", "arm"), retired, ["study", "arm"]).select("study", "row_uid", "problem")


# ---- evidence


@query("""WITH l AS (SELECT doc_id, string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
q AS (SELECT doc_id, ls, unnest(ls) AS quote, generate_subscripts(ls, 1) AS n FROM l), w AS (SELECT doc_id, quote, ls, CASE WHEN n % 3 = 0 THEN n + 1 ELSE n END AS line FROM q)
SELECT doc_id AS source_id, problem, count(*) AS n FROM (SELECT doc_id, CASE WHEN quote = '' THEN 'empty quote' WHEN line > len(ls) THEN 'line out of range' WHEN NOT contains(ls[line], quote) THEN 'not on this line' END AS problem FROM w) GROUP BY ALL""")
def quote_lines(spark, d):
    """Every line of every document as a quotation, each third one with the number of the next line."""
    docs = table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("source_id"), "text")
    n = F.col("line")
    quotes = evidence.source_lines(docs).select("source_id", F.when(n % 3 == 0, n + 1).otherwise(n).alias("line"), F.col("text").alias("quote"))
    return evidence.check_quotes(quotes, docs).groupBy("source_id", "problem").agg(F.count("*").alias("n"))


@query()
def quote_locator(spark, d):
    """The abstract of every record that has a document, looked for in it."""
    docs = table(spark, d, "documents").where("record_id IS NOT NULL").select(F.col("record_id"), F.col("doc_id").alias("source_id"), "text")
    quotes = docs.select("source_id", "record_id").join(table(spark, d, "records").select("record_id", F.col("abstract").alias("quote")), "record_id").select("source_id", "quote")
    return evidence.locate_quotes(quotes, docs.select("source_id", "text")).groupBy("found").agg(F.count("*").alias("n"))


@query(r"""WITH h AS (SELECT doc_id AS source_id, list_filter(string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)), lambda x: regexp_matches(x, '^(?:Study-ID|Version|Design):')) AS p FROM documents),
k AS (SELECT *, len(list_distinct(list_transform(p, lambda x: split_part(x, ':', 1)))) AS n FROM h)
SELECT source_id, CASE WHEN len(p) > n THEN 'repeated header' WHEN n < 3 THEN 'missing header' END AS problem FROM k""")
def report_headers(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("source_id"), F.coalesce("text", F.lit("")).alias("text"))
    return evidence.headers(docs, ["Study-ID", "Version", "Design"]).select("source_id", "problem")


@query(r"""WITH h AS (SELECT doc_id AS source_id, regexp_extract(text, '(?m)^Study-ID: *(.*)$', 1) AS study, regexp_extract(text, '(?m)^Version: *(.*)$', 1) AS version FROM documents WHERE text LIKE '%Study-ID:%')
SELECT study AS "Study_ID", source_id, row_number() OVER (PARTITION BY study ORDER BY version = 'journal' DESC, source_id DESC) = 1 AS representative FROM h WHERE study <> ''""")
def study_map(spark, d):
    h = lambda k: F.regexp_extract("text", f"(?m)^{k}: *(.*)$", 1)
    r = table(spark, d, "documents").where("text LIKE '%Study-ID:%'").select(F.col("doc_id").alias("source_id"), h("Study-ID").alias("Study_ID"), h("Version").alias("version"))
    return lookup.representatives(r.where("Study_ID <> ''")).select("Study_ID", "source_id", "representative")


@query("""SELECT record_id, first_value(record_id) OVER (PARTITION BY title ORDER BY record_id) <> record_id AS duplicate FROM records WHERE title IS NOT NULL""")
def exact_duplicates(spark, d):
    r = table(spark, d, "records").where("title IS NOT NULL").select("record_id", "title")
    return lookup.exact_duplicates(r, "title", "record_id").select("record_id", F.col("duplicate_of").isNotNull().alias("duplicate"))


# ---- effects

_ARMS = """g AS (SELECT l_linestatus, l_returnflag, CAST(count(*) AS DOUBLE) AS n, avg(l_quantity) AS m, stddev_samp(l_quantity) AS s FROM lineitem GROUP BY ALL)"""
_G = """(1 - 3 / (4 * (t.n + c.n - 2) - 1)) * (t.m - c.m) / sqrt(((t.n - 1) * t.s * t.s + (c.n - 1) * c.s * c.s) / (t.n + c.n - 2))"""


@query(f"""WITH {_ARMS}, e AS (SELECT t.l_linestatus, t.l_returnflag AS t, c.l_returnflag AS c, {_G} AS g, t.n AS nt, c.n AS nc FROM g t JOIN g c ON t.l_linestatus = c.l_linestatus AND t.l_returnflag < c.l_returnflag)
SELECT l_linestatus, t, c, round(g, 8) AS g, round(sqrt((nt + nc) / (nt * nc) + g * g / (2 * (nt + nc - 2))), 8) AS se FROM e""")
def hedges_g(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_linestatus", "l_returnflag").agg(F.count("*").alias("n"), F.avg("l_quantity").alias("m"), F.stddev_samp("l_quantity").alias("s"))
    c = g.toDF("l_linestatus", "c", "nc", "mc", "sc")
    e = g.join(c, "l_linestatus").where("l_returnflag < c").withColumn("e", stats.hedges_g(*[F.col(x) for x in ("m", "s", "n", "mc", "sc", "nc")]))
    return e.where("e.status = 'ok'").select("l_linestatus", F.col("l_returnflag").alias("t"), "c", F.round("e.g", 8).alias("g"), F.round("e.se", 8).alias("se"))


_EVENTS = """x AS (SELECT o_orderpriority AS p, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE o_orderstatus = 'F' {more}) AS DOUBLE) AS e FROM orders GROUP BY 1),
y AS (SELECT t.p AS t, c.p AS c, t.e AS et, t.n AS nt, c.e AS ec, c.n AS nc, CASE WHEN t.e = 0 OR t.n = t.e OR c.e = 0 OR c.n = c.e THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS k FROM x t JOIN x c ON t.p < c.p),
z AS (SELECT t, c, k, et + k AS a, nt - et + k AS b, ec + k AS cc, nc - ec + k AS dd FROM y), j AS (SELECT *, CAST(1 AS DOUBLE) - 3 / (4 * (a + b + cc + dd - 2) - 1) AS j FROM z)
SELECT t, c, k > 0 AS corrected, round(j * (ln(a) + ln(dd) - ln(b) - ln(cc)) * sqrt(3) / pi(), 8) + CAST(0 AS DOUBLE) AS g, round(abs(j) * sqrt(3 * (1 / a + 1 / b + 1 / cc + 1 / dd) / (pi() * pi())), 8) AS se FROM j"""


def _log_odds(spark, d, event):
    x = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("t")).agg(F.count("*").alias("n"), F.count_if(event).alias("e"))
    y = x.join(x.toDF("c", "nc", "ec")).where("t < c").withColumn("r", stats.log_odds_g(*[F.col(k) for k in ("e", "n", "ec", "nc")]))
    return y.where("r.status = 'ok'").select("t", "c", F.col("r.continuity_correction").alias("corrected"), (F.round("r.g", 8) + 0.0).alias("g"), F.round("r.se", 8).alias("se"))


@query("WITH " + _EVENTS.format(more=""))
def logor_g(spark, d):
    return _log_odds(spark, d, F.col("o_orderstatus") == "F")


@query("WITH " + _EVENTS.format(more="AND o_totalprice < 0"))
def zero_cell_g(spark, d):
    return _log_odds(spark, d, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 0))


@query("""WITH g AS (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n, avg(l_quantity) AS m, coalesce(stddev_samp(l_quantity), 0) AS s FROM lineitem GROUP BY 1)
SELECT status, count(*) AS k FROM (SELECT CASE WHEN n < 2 THEN 'n' WHEN s = 0 THEN 'variance' ELSE 'ok' END AS status FROM g) GROUP BY 1""")
def effect_guards(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.avg("l_quantity").alias("m"), F.coalesce(F.stddev_samp("l_quantity"), F.lit(0.0)).alias("s"))
    e = stats.hedges_g(F.col("m"), F.col("s"), F.col("n"), F.col("m"), F.col("s"), F.col("n"))
    return g.select(e["status"].alias("status")).groupBy("status").agg(F.count("*").alias("k"))


def _coded(spark, d):
    """Arms of a comparison by part brand: the means of orders with and without a discount; some inputs are missing."""
    l = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    arm = F.when(F.col("l_discount") > 0.05, "treatment").otherwise("comparator")
    g = l.groupBy(F.col("p_brand").alias("Study_ID"), F.lit("one").alias("Condition_ID"), F.col("p_size").cast("string").alias("Outcome_Metric"), arm.alias("Arm")).agg(
        F.count("*").alias("N"), F.avg("l_quantity").alias("mean"), F.nullif(F.stddev_samp("l_quantity"), F.lit(0.0)).alias("sd")
    )
    none = F.lit(None).cast("double")
    uid = F.concat_ws("/", "Study_ID", "Outcome_Metric", F.substring("Arm", 1, 1))
    return g.withColumns({"ES_Path": F.lit("means_sd"), "events": none, "total": none, "Row_UID": uid})


@query("""WITH g AS (SELECT p_brand AS s, CAST(p_size AS VARCHAR) AS o, l_discount > 0.05 AS t, count(*) AS n, nullif(stddev_samp(l_quantity), 0) AS sd FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT s AS "Study_ID", o AS "Outcome_Metric", bool_and(sd IS NOT NULL) AS computable, CAST(count(*) FILTER (WHERE sd IS NULL) AS BIGINT) AS n_missing FROM g GROUP BY ALL HAVING count(*) = 2""")
def computability(spark, d):
    pairs = effects.paired(_coded(spark, d)).where("problem IS NULL")
    return effects.computability(pairs).select("Study_ID", "Outcome_Metric", "computable", F.size("missing").cast(L).alias("n_missing"))


@query(f"""WITH a AS (SELECT p_brand AS s, CAST(p_size AS VARCHAR) AS o, l_discount > 0.05 AS t, CAST(count(*) AS DOUBLE) AS n, avg(l_quantity) AS m, nullif(stddev_samp(l_quantity), 0) AS s_ FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
g AS (SELECT s AS st, o, t, n, m, s_ AS s FROM a) SELECT t.st AS "Study_ID", t.o AS "Outcome_Metric", round({_G}, 8) AS g FROM g t JOIN g c ON t.st = c.st AND t.o = c.o AND t.t AND NOT c.t WHERE t.s IS NOT NULL AND c.s IS NOT NULL AND t.n >= 2 AND c.n >= 2""")
def comparison_effects(spark, d):
    pairs = effects.paired(_coded(spark, d)).where("problem IS NULL")
    return effects.effects(pairs).select("Study_ID", "Outcome_Metric", F.round("g", 8).alias("g"))


def _spread(spark, d):
    e = table(spark, d, "events").groupBy("user_id", "event_type", F.date_trunc("week", F.col("ts")).alias("week")).agg(F.count("*").alias("N"), F.round(F.stddev_samp("value"), 8).alias("sd"))
    return e.select(F.col("user_id").cast("string").alias("Study_ID"), F.col("event_type").alias("Outcome_Metric"), "N", "sd", F.concat_ws("/", "user_id", "event_type", F.date_format("week", "yyyy-MM-dd")).alias("Row_UID"))


_SPREAD = """e AS (SELECT CAST(user_id AS VARCHAR) AS st, event_type AS o, date_trunc('week', ts) AS wk, count(*) AS n, round(stddev_samp(value), 8) AS sd FROM events GROUP BY ALL),
v AS (SELECT st || '/' || o || '/' || strftime(wk, '%Y-%m-%d') AS uid, * FROM e WHERE sd > 0), tops AS (SELECT st, o, max(sd) AS top, median(sd) AS m FROM v GROUP BY ALL)"""


@query(f"""WITH {_SPREAD} SELECT uid AS "Row_UID", round(sd, 6) AS value, round(top, 6) AS reference_sd FROM v JOIN tops USING (st, o) WHERE sd < top / 3""")
def dispersion_a(spark, d):
    f = effects.dispersion_flags(_spread(spark, d)).where("rule = 'A'")
    return f.select("Row_UID", F.round("value", 6).alias("value"), F.round("reference_sd", 6).alias("reference_sd"))


@query(f"""WITH {_SPREAD}, typ AS (SELECT a.st, a.o, median(b.m) AS t FROM tops a JOIN tops b ON a.o = b.o AND a.st <> b.st GROUP BY ALL)
SELECT uid AS "Row_UID", round(sd, 6) AS value, round(t, 6) AS reference_sd FROM v JOIN tops USING (st, o) JOIN typ USING (st, o)
WHERE NOT sd < top / 3 AND n >= 2 AND sd < t / 3 AND abs(ln(sd * sqrt(n) / t)) < abs(ln(sd / t))""")
def dispersion_b(spark, d):
    f = effects.dispersion_flags(_spread(spark, d)).where("rule = 'B'")
    return f.select("Row_UID", F.round("value", 6).alias("value"), F.round("reference_sd", 6).alias("reference_sd"))


@query(f"""WITH {_ARMS}, e AS (SELECT t.l_linestatus, t.l_returnflag AS t, c.l_returnflag AS c, {_G} AS g FROM g t JOIN g c ON t.l_linestatus = c.l_linestatus AND t.l_returnflag < c.l_returnflag)
SELECT l_linestatus, t, c, round(g, 8) AS g FROM e""")
def sql_hedges_g(spark, d):
    sqlfunctions.register(spark)
    table(spark, d, "lineitem").groupBy("l_linestatus", "l_returnflag").agg(
        F.count("*").cast(D).alias("n"), F.avg("l_quantity").alias("m"), F.stddev_samp("l_quantity").alias("s")
    ).createOrReplaceTempView("evspark_arms")
    return spark.sql("""SELECT t.l_linestatus, t.l_returnflag AS t, c.l_returnflag AS c, round(hedges_g(t.m, t.s, t.n, c.m, c.s, c.n), 8) AS g
      FROM evspark_arms t JOIN evspark_arms c ON t.l_linestatus = c.l_linestatus AND t.l_returnflag < c.l_returnflag""")


@query("""WITH e AS (SELECT o_orderpriority AS stratum, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS round, count(*) AS audited, count(*) FILTER (WHERE o_orderstatus = 'P') AS missed FROM orders GROUP BY ALL)
SELECT stratum, round, CAST(sum(audited) OVER w AS BIGINT) AS audited_so_far, CAST(sum(missed) OVER w AS BIGINT) AS missed_so_far,
  coalesce(missed = 0 AND lag(missed) OVER (PARTITION BY stratum ORDER BY round) = 0, false) AS may_stop FROM e WINDOW w AS (PARTITION BY stratum ORDER BY round ROWS UNBOUNDED PRECEDING)""")
def audit_rounds(spark, d):
    o = table(spark, d, "orders")
    r = o.groupBy(F.col("o_orderpriority").alias("stratum"), (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast(L).alias("round")).agg(
        F.count("*").alias("audited"), F.count_if(F.col("o_orderstatus") == "P").alias("missed")
    )
    return audit.round_totals(r).select("stratum", "round", "audited_so_far", "missed_so_far", "may_stop")


@query("""SELECT s_nationkey, count(*) AS n_rows, round(avg(s_acctbal), 6) AS s_acctbal FROM supplier GROUP BY 1""")
def unit_means(spark, d):
    return lookup.by_unit(table(spark, d, "supplier"), ["s_nationkey"], ["s_acctbal"]).withColumn("s_acctbal", F.round("s_acctbal", 6))


@query("""WITH r AS (SELECT request_id, attempt, regexp_replace(lower(trim(kind)), '[\\W_]+', '_', 'g') AS kind, raw_text FROM responses)
SELECT request_id, count(*) AS attempts, count(*) FILTER (WHERE kind = 'technical_error') AS technical_failures,
  CAST(coalesce(min(CASE WHEN kind = 'response' AND length(coalesce(raw_text, '')) > 60 THEN attempt END), 0) AS BIGINT) AS accepted FROM r GROUP BY request_id""".replace("\\\\", "\\"))
def stream_attempts(spark, d):
    schema = table(spark, d, "responses").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/responses.parque*")
    out = attempts.run_to_end(attempts.running_attempts(stream, F.length(F.coalesce("raw_text", F.lit(""))) > 60), "complete")
    return out.withColumn("accepted", F.coalesce("accepted", F.lit(0)).cast(L))


# ---- lookups, JSON, manifests


@query("""WITH n AS (SELECT c_nationkey, avg(c_acctbal) AS v, count(*) AS k FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1 HAVING count(*) > 1),
r AS (SELECT n_regionkey, avg(c_acctbal) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT s_suppkey, round(coalesce(n.v, r.v), 6) AS value, CASE WHEN n.v IS NOT NULL THEN 1 WHEN r.v IS NOT NULL THEN 2 END AS level
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN n ON s_nationkey = n.c_nationkey LEFT JOIN r USING (n_regionkey)""")
def priority_lookup(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    own = c.where("c_mktsegment = 'BUILDING'").groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(F.avg("c_acctbal").alias("value"), F.count("*").alias("k")).where("k > 1")
    region = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").agg(F.avg("c_acctbal").alias("value"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "s_nationkey", "n_regionkey")
    out = lookup.priority_lookup(s, [(own, ["s_nationkey"]), (region, ["n_regionkey"])], "value")
    return out.select("s_suppkey", F.round("value", 6).alias("value"), "level")


@query("""WITH p AS (SELECT props, unnest(['whole', 'twice', 'repeated', 'nan', 'cut']) AS way FROM events)
SELECT way, way = 'whole' AS ok, count(*) AS n FROM p GROUP BY ALL""")
def strict_json_checks(spark, d):
    """The properties of every event as they are, twice over, with a repeated key, with no number, and cut."""
    p = F.col("props")
    ways = {"whole": p, "twice": F.concat(p, F.lit(" "), p), "repeated": F.concat(F.lit('{"x":1,"x":'), p, F.lit("}")), "nan": F.concat(F.lit('{"x":NaN,"y":'), p, F.lit("}")), "cut": F.substring(p, F.lit(1), F.length(p) - 1)}
    rows = table(spark, d, "events").select(F.explode(F.array(*[F.struct(F.lit(k).alias("way"), v.alias("text")) for k, v in ways.items()])).alias("x"))
    return rows.select("x.way", strict_json(F.col("x.text")).alias("j")).groupBy("way", F.col("j.ok").alias("ok")).agg(F.count("*").alias("n"))


@query("""SELECT change, count(*) AS n FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN 'missing' WHEN doc_id % 10 = 1 THEN 'added' WHEN doc_id % 10 = 2 THEN 'changed' END AS change FROM documents) WHERE change IS NOT NULL GROUP BY change""")
def manifest_diff(spark, d):
    t = table(spark, d, "documents").select(F.col("doc_id").alias("k"), F.col("doc_id").cast("string").alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    old = t.where("k % 10 <> 1").select("path", "sha256")
    new = t.where("k % 10 <> 0").select("path", F.when(F.col("k") % 10 == 2, F.lit("x")).otherwise(F.col("sha256")).alias("sha256"))
    return provenance.compare(old, new).groupBy("change").agg(F.count("*").alias("n"))


@query(r"""WITH r AS (SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN l_quantity > 45 THEN 'l_quantity is above 45' END, CASE WHEN l_discount < 0.01 THEN 'l_discount is below 0.01' END,
  CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'l_returnflag is none of the listed values' END], lambda x: x IS NOT NULL) AS e FROM lineitem)
SELECT errors, count(*) AS n FROM (SELECT array_to_string(e, '; ') AS errors FROM r) GROUP BY errors""")
def row_validation(spark, d):
    var = lambda n, t, **k: {"name": n, "type": t, "nullable": False, "owner": "executor", **k}
    book = {
        "variables": [var("id", "string"), var("l_quantity", "number", maximum=45), var("l_discount", "number", minimum=0.01), var("l_returnflag", "string", allowed_values=["A", "N"])],
        "unit": {"identity_fields": ["id"]},
    }
    l = table(spark, d, "lineitem").withColumn("rid", F.monotonically_increasing_id())
    rows = l.select(F.col("rid").alias("row_id"), F.to_json(F.struct(F.col("rid").cast("string").alias("id"), "l_quantity", "l_discount", "l_returnflag")).alias("row"))
    return codebook.validate_rows(rows, book).select(F.array_join("errors", "; ").alias("errors")).groupBy("errors").agg(F.count("*").alias("n"))


@query(f"""WITH {_SCREEN}, r AS (SELECT record_id, length(coalesce(abstract, '')) AS n, row_number() OVER (PARTITION BY coalesce(title, '') ORDER BY record_id) AS k FROM records),
u AS (SELECT r.record_id, n, decision FROM r JOIN s USING (record_id) WHERE k = 1), f AS (SELECT * FROM u WHERE decision = 'keep'),
h AS (SELECT record_id, sha256(record_id) AS h FROM records), v AS (SELECT record_id, substr(h, 1, 1) < '8' AS a, substr(h, 2, 1) < '8' AS b, substr(h, 3, 1) < '8' AS c, substr(h, 4, 1) < '8' AS d FROM h),
m AS (SELECT count(*) FILTER (WHERE ((a = b AND a) OR (a <> b AND c)) AND d) AS n FROM v)
SELECT (SELECT count(*) FROM r WHERE k > 1) AS duplicates, (SELECT count(*) FROM u) AS screened_records, (SELECT count(*) FROM u WHERE decision = 'exclude') AS first_phase_excluded,
  (SELECT count(*) FROM f) AS full_texts_assessed, (SELECT count(*) FROM f WHERE n < 300) AS full_text_excluded, (SELECT count(*) FROM f WHERE n >= 300) AS included_reports,
  m.n AS confirmed_misses, (SELECT count(*) FROM r) AS search_records, true AS balanced FROM m""")
def flow_counts(spark, d):
    """The path of all records: copies by title, screening, two versions of a rule over full texts, votes and confirmations."""
    r = table(spark, d, "records")
    records = r.select("record_id", F.col("record_id").alias("source_id"), F.coalesce("title", F.lit("")).alias("source_key"), "title", "abstract", "language", F.col("record_id").alias("ord"))
    texts = r.select(F.col("record_id").alias("source_id"), F.length(F.coalesce("abstract", F.lit(""))).alias("n"))
    rules = spark.createDataFrame([("1", 600), ("2", 300)], "version string, least int")
    votes = _votes(spark, d)
    human = audit.routed_votes(votes).where("majority = 'include'").select("source_id", F.when(F.substring(F.sha2("source_id", 256), 4, 1) < "8", "include").otherwise("exclude").alias("decision"))
    return flows.flow_counts(flows.flow(records, CRITERIA, texts, rules, F.col("n") >= F.col("least"), votes, human), "2")


@query("""WITH h AS (SELECT record_id AS source_id, sha256(record_id) AS h FROM records), v AS (
  SELECT source_id, substr(h, 1, 1) < '8' AS a, substr(h, 2, 1) < '8' AS b, substr(h, 3, 1) < '8' AS c, substr(h, 4, 1) AS d FROM h), m AS (SELECT source_id, (a = b AND a) OR (a <> b AND c) AS yes, d FROM v)
SELECT source_id, CASE WHEN yes THEN 'include' ELSE 'exclude' END AS majority, CASE WHEN yes AND d < '8' THEN 'include' ELSE 'exclude' END AS final,
  CASE WHEN yes AND d >= 'e' THEN 'adjudication missing' WHEN NOT yes AND d < '4' THEN 'unused adjudication' END AS problem FROM m""")
def confirmations(spark, d):
    """Votes and a person's word: only what both include counts; words nobody asked for and missing ones are named."""
    routed = audit.routed_votes(_votes(spark, d))
    digit = F.substring(F.sha2("source_id", 256), 4, 1)
    human = routed.where(((F.col("majority") == "include") & (digit < "e")) | ((F.col("majority") == "exclude") & (digit < "4"))).select(
        "source_id", F.when(digit < "8", "include").otherwise("exclude").alias("decision")
    )
    return audit.confirmed(routed, human).select("source_id", "majority", "final", "problem")


@query("""WITH s AS (SELECT o_orderkey AS source_id, o_totalprice >= 200000 AS a, o_totalprice >= 100000 AS b FROM orders)
SELECT source_id, 'confirmed miss still excluded' AS problem FROM s WHERE NOT b AND source_id % 3 = 0 UNION ALL SELECT source_id, 'exclusion without an audit' FROM s WHERE NOT b AND source_id % 5 <> 0""")
def rule_revisions(spark, d):
    """A rule in two versions over all orders, the second against confirmed misses and audited exclusions."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("source_id"), "o_totalprice")
    rules = spark.createDataFrame([("1", 200000.0), ("2", 100000.0)], "version string, least double")
    screened = audit.rule_versions(o, rules, F.col("o_totalprice") >= F.col("least"))
    return audit.revision_errors(screened, o.where("source_id % 3 = 0"), o.where("source_id % 5 = 0"), "2").select("source_id", "problem")


@query("""WITH k AS (SELECT doc_id AS path, doc_id % 4 AS k FROM documents)
SELECT CAST(path AS VARCHAR) AS path, CASE k WHEN 0 THEN 'missing' WHEN 1 THEN 'filled' WHEN 2 THEN 'current' ELSE 'outdated' END AS status FROM k""")
def template_states(spark, d):
    """Documents as templates of a project: unchanged, filled in, gone, or overtaken by a newer one."""
    t = table(spark, d, "documents").select(F.col("doc_id").alias("k"), F.col("doc_id").cast("string").alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    project = t.where("k % 4 <> 0").select("path", F.when(F.col("k") % 4 == 1, F.lit("x")).otherwise(F.col("sha256")).alias("sha256"))
    current = t.select("path", F.when(F.col("k") % 4 == 3, F.lit("y")).otherwise(F.col("sha256")).alias("sha256"))
    return provenance.template_status(project, t.select("path", "sha256"), current)


@query("""WITH r AS (SELECT coalesce(source, '') AS source, record_id, coalesce(year, '') AS year, coalesce(language, '') AS language FROM records)
SELECT record_id, CASE WHEN NOT regexp_full_match(year, '[0-9]{4}') THEN 'value' WHEN language = '' THEN 'default' END AS level_missing FROM r""")
def cached_values(spark, d):
    """Attributes looked up in a cache of one version; what the cache lacks is told by its absence."""
    r = table(spark, d, "records").select("record_id", F.coalesce("year", F.lit("")).alias("year"), F.coalesce("language", F.lit("")).alias("language"))
    cache = r.where(F.col("year").rlike("^[0-9]{4}$")).select(F.col("record_id").alias("entity"), F.lit("2").alias("cache_version"), F.col("language").alias("v"))
    old = r.select(F.col("record_id").alias("entity"), F.lit("1").alias("cache_version"), F.lit("old").alias("v"))
    found = lookup.cached_attributes(r.select(F.col("record_id").alias("entity")), cache.unionByName(old), "2")
    return found.select(F.col("entity").alias("record_id"), F.when(F.col("v").isNull(), "value").when(F.col("v") == "", "default").alias("level_missing"))


@query("""WITH e AS (SELECT l_orderkey, l_linenumber, l_quantity AS events, l_quantity + l_tax * 100 - 4 AS total, l_linenumber % 3 AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN k = 0 THEN 'inputs of events_total given' WHEN k = 1 AND events > total THEN 'events exceed total' WHEN k = 2 THEN 'unknown path' END AS problem FROM e""")
def computation_paths(spark, d):
    """The way of computing that a row names against the inputs it gives, for all line items."""
    k = F.pmod(F.col("l_linenumber"), F.lit(3))
    total = F.round(F.col("l_quantity") + F.col("l_tax") * 100 - 4, 6)
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(k == 0, "means_sd").when(k == 1, "events_total").otherwise("other").alias("ES_Path"), F.col("l_quantity").alias("events"), total.alias("total"),
        F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("sd"),
    )
    return rows.select("l_orderkey", "l_linenumber", codebook.path_problem().alias("problem"))


@query("""WITH q AS (SELECT o_totalprice > 150000 AS n, o_custkey % 2 = 1 AS m, o_orderkey % 4 AS e FROM orders), f AS (
  SELECT 'N' AS field, n AS given, CASE WHEN e = 0 THEN 0 WHEN e = 1 THEN 2 ELSE 1 END AS k FROM q UNION ALL SELECT 'mean', m, CASE WHEN e = 3 THEN 0 ELSE 1 END FROM q)
SELECT field, problem, count(*) AS n FROM (SELECT field, CASE WHEN given AND k = 0 THEN 'no evidence' WHEN NOT given AND k > 0 THEN 'evidence for nothing' WHEN given AND k > 1 THEN 'evidence given twice' END AS problem FROM f) WHERE problem IS NOT NULL GROUP BY ALL""")
def evidence_coverage(spark, d):
    """Numbers without evidence and evidence for no number, with orders as arms."""
    o = table(spark, d, "orders").withColumn("e", F.pmod(F.col("o_orderkey"), F.lit(4)))
    ids = [F.col("o_orderkey").alias("Study_ID"), F.lit("treatment").alias("Arm")]
    rows = o.select(
        *ids, F.when(F.col("o_totalprice") > 150000, F.col("o_totalprice")).alias("N"), F.when(F.col("o_custkey") % 2 == 1, F.col("o_totalprice")).alias("mean"),
        *[F.lit(None).cast("double").alias(c) for c in ("sd", "events", "total")],
    )
    n = F.when(F.col("e") == 0, 0).when(F.col("e") == 1, 2).otherwise(1)
    fields = F.concat(F.array_repeat(F.lit("N"), n), F.array_repeat(F.lit("mean"), F.when(F.col("e") == 3, 0).otherwise(1)))
    given = o.select(*ids, F.explode(fields).alias("field"))
    return codebook.evidence_gaps(rows, given).groupBy("field", "problem").agg(F.count("*").alias("n"))


# ---- answers

_ANSWERS = """a AS (SELECT DISTINCT request_id, CAST(attempt AS BIGINT) AS attempt, kind, raw_text FROM responses),
q AS (SELECT request_id, min(request) AS request FROM requests GROUP BY 1),
j AS (SELECT a.*, CASE WHEN json_valid(raw_text) AND json_type(raw_text) = 'OBJECT' THEN raw_text END AS o, request,
  json_extract_string(request, '$.sources[0].source_id') AS sid, string_split(json_extract_string(request, '$.sources[0].text'), chr(10)) AS ls FROM a LEFT JOIN q USING (request_id)),
e AS (SELECT *, list_filter(json_keys(o), lambda x: x NOT IN ('rationale', 'unresolved')) AS ks, CAST(json_extract(o, '$.criterion_ids') AS VARCHAR[]) AS ids,
  json_extract(o, '$.evidence') AS ev, TRY_CAST(json_extract(o, '$.evidence.line') AS BIGINT) AS ln, json_extract_string(o, '$.evidence.quote') AS qu FROM j),
v AS (SELECT request_id, attempt, kind, CASE WHEN request IS NULL THEN 'no request' WHEN o IS NULL THEN 'no object' WHEN list_sort(ks) <> ['criterion_ids', 'decision', 'evidence'] THEN 'other keys'
  WHEN coalesce(json_extract_string(o, '$.decision') NOT IN ('include', 'exclude'), true) THEN 'no decision'
  WHEN ids IS NULL OR len(ids) = 0 OR len(list_filter(ids, lambda x: NOT regexp_full_match(x, 'C[1-9]'))) > 0 THEN 'unknown criteria'
  WHEN coalesce(json_type(ev) <> 'OBJECT', true) OR list_sort(json_keys(ev)) <> ['line', 'quote', 'source_id'] THEN 'no quotation'
  WHEN coalesce(json_extract_string(ev, '$.source_id') <> sid, true) THEN 'quotation of another source' WHEN ln IS NULL OR ln < 1 OR ln > len(ls) THEN 'line out of range'
  WHEN coalesce(qu, '') = '' OR NOT contains(ls[ln], qu) THEN 'quotation not on its line' END AS problem FROM e)"""


def _answers(spark, d) -> DataFrame:
    a = table(spark, d, "responses").select("request_id", "attempt", "kind", "raw_text").distinct()
    check = answers.screening_answer({f"C{i}" for i in range(1, 10)}, ("rationale", "unresolved"))
    return answers.checked(a, table(spark, d, "requests"), check)


@query(f"WITH {_ANSWERS} SELECT request_id, attempt, kind, problem FROM v")
def screening_answers(spark, d):
    """Every answer against its request: keys, decision, criteria, and the quotation on its line of the source."""
    return _answers(spark, d)


@query(f"""WITH {_ANSWERS}, k AS (SELECT request_id, attempt, CASE regexp_replace(lower(trim(kind)), '[\\W_]+', '_', 'g') WHEN 'technical_error' THEN 'TECHNICAL_FAILURE'
  WHEN 'response' THEN CASE WHEN problem IS NULL THEN 'VALID' ELSE 'INVALID_RESPONSE' END END AS status FROM v),
g AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY attempt) AS k, min(CASE WHEN status = 'VALID' THEN attempt END) OVER (PARTITION BY request_id) AS first FROM k)
SELECT status, CASE WHEN status IS NULL THEN 'unknown kind' WHEN attempt <> k THEN 'attempts are not 1 to n' WHEN attempt > first THEN 'attempt after a valid one' END AS problem, count(*) AS n FROM g GROUP BY ALL""")
def replayed_attempts(spark, d):
    """All logged attempts replayed under the validator of answers."""
    log = audit.attempt_log(_answers(spark, d), F.col("problem").isNull())
    return log.groupBy("status", "problem").agg(F.count("*").alias("n"))


@query(r"""SELECT request_id, nullif(regexp_extract(request, '(?:^|[^\\])"(reviewer|decision|rationale)"\s*:', 1), '') AS shown FROM requests""")
def blinding(spark, d):
    """Requests that show what a reviewer must not see; here all name the reviewer."""
    return table(spark, d, "requests").select("request_id", answers.shows(F.col("request"), ["reviewer", "decision", "rationale"]).alias("shown"))


@query("""SELECT route, count(*) AS n FROM (SELECT CASE o_orderkey % 6 WHEN 0 THEN 'rejected' WHEN 1 THEN 'correction' WHEN 2 THEN 'needs_human' WHEN 3 THEN 'needs_human' ELSE 'malformed' END AS route FROM orders) GROUP BY route""")
def three_way_outcomes(spark, d):
    k = F.pmod(F.col("o_orderkey"), F.lit(6))
    outcome = F.when(k == 0, answers.SUPPORTED).when(k == 3, answers.AMBIGUOUS).when(k == 5, "other").otherwise(answers.CORRECTED)
    price = F.col("o_totalprice").cast("string")
    corrected = F.when(k == 1, price).when(k == 2, F.lit("0"))
    judged = table(spark, d, "orders").select(outcome.alias("outcome"), corrected.alias("corrected"), price.alias("proposed"))
    return answers.three_way(judged).groupBy("route").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT o_orderkey, o_orderdate < DATE '1998-01-01' AS reviewed, o_custkey % 3 > 0 AS available, o_orderstatus <> 'P' AS prepared, o_orderstatus = 'F' AS coded FROM orders)
SELECT problem, count(*) AS n FROM (SELECT CASE WHEN available AND NOT reviewed THEN 'available but not reviewed' WHEN prepared AND NOT available THEN 'prepared but not available' WHEN coded AND NOT prepared THEN 'coded but not prepared' END AS problem FROM s) GROUP BY problem""")
def tracker_states(spark, d):
    o = table(spark, d, "orders").select(
        (F.col("o_orderdate") < F.lit("1998-01-01").cast("date")).alias("reviewed"), (F.col("o_custkey") % 3 > 0).alias("available"), (F.col("o_orderstatus") != "P").alias("prepared"), (F.col("o_orderstatus") == "F").alias("coded")
    )
    return answers.tracked(o).groupBy("problem").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'o_totalprice' WHEN 1 THEN 'o_orderpriority' END AS "column" FROM orders WHERE o_orderkey % 5 < 3""")
def differing_cells(spark, d):
    """All orders against a copy with changed cells, tiny differences and a lost part."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderpriority")
    k = F.pmod(F.col("o_orderkey"), F.lit(5))
    price = F.when(k == 0, F.col("o_totalprice") * (1 + 1e-9)).when(k == 3, F.col("o_totalprice") * (1 + 1e-14)).otherwise(F.col("o_totalprice"))
    copy = o.where(k != 2).withColumns({"o_totalprice": price, "o_orderpriority": F.when(k == 1, "x").otherwise(F.col("o_orderpriority"))})
    return answers.differing(copy, o, ["o_orderkey"])
