import json
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from evspark.functions import jsonx, stats, text
from evspark.operators import answers, audit, codebook, components, effects, evidence, files_check, lookup, provenance, registry, screening
from evspark.plans import flow
from evspark.sources import csv_rows, exports, files
from evspark.streaming import attempts


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# ---- functions


def test_text_functions(spark):
    df = spark.createDataFrame([("Ärger – ﬁve ½ Ünits²",), ("Plain  Title!",), (None,), ("",)], "t string")
    assert [r["n"] for r in rows(df.select(text.norm_text(F.col("t")).alias("n")))] == ["arger five 1 2 units2", "plain title", "", ""]
    d = spark.createDataFrame([(" https://doi.org/doi:10.1/A ",), ("DOI:10.2/b",), (None,)], "d string")
    assert [r["n"] for r in rows(d.select(text.norm_doi(F.col("d")).alias("n")))] == ["10.1/a", "10.2/b", ""]
    a = spark.createDataFrame([("Stone, P. Q.",), ("Stone P",), ("",), (None,)], "a string")
    assert [r["n"] for r in rows(a.select(text.surname(F.col("a")).alias("n")))] == ["Stone", "Stone", "", ""]
    s = spark.createDataFrame([("One cat, two cats; a cat.",), (None,)], "s string").select(text.screening_text(F.col("s")).alias("s"))
    found = rows(s.select(text.snippets(F.col("s"), ["cat"], [r"tw\w"]).alias("h")))
    assert [h["term"] for h in found[0]["h"]] == ["cat", "cat", r"tw\w"] and found[1]["h"] == []


@pytest.mark.parametrize("glob,yes,no", [("Research Support, *", "Research Support, Other", "research support, x"), ("[JU]N?B", "UNPB", "UNP"), ("a.b", "a.b", "axb"), ("[!x]y", "ay", "xy")])
def test_globs(spark, glob, yes, no):
    df = spark.createDataFrame([(yes,), (no,)], "t string")
    assert [r["m"] for r in rows(df.select(text.any_glob(F.col("t"), [glob]).alias("m")))] == [True, False]


@pytest.mark.parametrize("bad", ['{"a":1,"a":2}', '{"a":NaN}', '{"a":Infinity}', '{"a":[1e999]}', "{} {}", "", "{'a':1}"])
def test_strict_json_refuses(spark, bad):
    with pytest.raises(ValueError):
        jsonx.strict(bad)
    assert rows(spark.createDataFrame([(bad,)], "t string").select(jsonx.strict_json(F.col("t"))["ok"].alias("ok"))) == [{"ok": False}]


def test_canonical_json():
    assert jsonx.canonical({"b": [1, 2.5], "a": "ü"}) == '{"a":"ü","b":[1,2.5]}'
    assert jsonx.same_value(10, 10.0) and not jsonx.same_value(1, True) and jsonx.same_value({"a": 1}, {"a": 1})


def _means(spark, *x):
    df = spark.createDataFrame([tuple(None if v is None else float(v) for v in x)], "mt double, st double, nt double, mc double, sc double, nc double")
    return rows(df.select(stats.hedges_g(*[F.col(c) for c in df.columns]).alias("e")))[0]["e"]


def test_hedges_g(spark):
    e = _means(spark, 65, 10, 40, 60, 10, 40)
    assert math.isclose(e["g"], 0.49517684887459806, rel_tol=1e-12) and math.isclose(e["se"], 0.22709424384508942, rel_tol=1e-12)
    assert math.isclose(_means(spark, 60, 10, 40, 65, 10, 40)["g"], -e["g"], rel_tol=1e-12)
    assert math.isclose(_means(spark, 650, 100, 40, 600, 100, 40)["g"], e["g"], rel_tol=1e-12)
    assert _means(spark, 1, 0, 10, 0, 1, 10)["status"] == "ok"


@pytest.mark.parametrize("x,status", [((1, 0, 10, 0, 0, 10), "variance"), ((1, -1, 10, 0, 1, 10), "sd"), ((1, 1, 1, 0, 1, 10), "n"), ((1, 1, 3.5, 0, 1, 10), "n"),
                                      ((None, 1, 10, 0, 1, 10), "not finite"), ((float("inf"), 1, 10, 0, 1, 10), "not finite"), ((float("nan"), 1, 10, 0, 1, 10), "not finite")])
def test_guards_of_means(spark, x, status):
    e = _means(spark, *x)
    assert e["status"] == status and e["g"] is None


@pytest.mark.parametrize("x,status", [((30, 50, 20, 50), "ok"), ((0, 10, 5, 10), "ok"), ((2.5, 10, 4.5, 10), "ok"), ((-1, 10, 5, 10), "events"), ((11, 10, 5, 10), "events"), ((None, 10, 5, 10), "not finite")])
def test_log_odds(spark, x, status):
    df = spark.createDataFrame([tuple(None if v is None else float(v) for v in x)], "a double, b double, c double, d double")
    e = rows(df.select(stats.log_odds_g(*[F.col(c) for c in "abcd"]).alias("e")))[0]["e"]
    assert e["status"] == status
    if status == "ok":
        k = 0.5 if x[0] == 0 else 0
        a, b, c, d = x[0] + k, x[1] - x[0] + k, x[2] + k, x[3] - x[2] + k
        j = 1 - 3 / (4 * (a + b + c + d - 2) - 1)
        assert math.isclose(e["g"], j * math.log(a * d / (b * c)) * math.sqrt(3) / math.pi, rel_tol=1e-12)
        assert e["continuity_correction"] is (k > 0)


# ---- graphs


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(7)
    edges = {
        "path": [(i, i + 1) for i in range(200)], "star": [(0, i) for i in range(1, 200)] + [(500, 501), (7, 7)],
        "random": [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(120)], "none": [(1, 1)],
    }[kind]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    linked = {x for u, v in edges if u != v for x in (u, v)}
    found = {r["id"]: r["group"] for r in rows(components.components(spark.createDataFrame(edges, "u long, v long")))}
    assert found == {x: find(x) for x in linked}


# ---- sources


def test_exports_of_three_formats(spark):
    med = "PMID- 7\nTI  - A long\n      title\nAID - x [pii]\nAID - 10.1/q [doi]\nDP  - 2001 May\nAU  - Lee B\nPT  - Letter\nPT  - Comment\nLA  - eng\nLA  - ger\n\n\nTI  - no id\n"
    wos = "FN x\nVR 1.0\nPT J\nAU Lee, B\n   Kim, C\nTI Two\n   parts\nDT Article; Early Access\nEA MAR 2020\nUT WOS:A1990-07\nER\n\nPT J\nTI after the last mark"
    ris = "TY  - JOUR\nT1  - Same\nY1  - 1999/01\nA1  - Fox, D\nUR  - https://e.org/10.1234/zz\nN2  - text\ngoes on\nM3  - Letter; Note\nER  - \n" * 2 + "TY  - UNPB\nTI  - Open end\n"
    df = spark.createDataFrame([("b/m.txt", "﻿".strip("﻿") + med), ("a/w.txt", wos), ("c/My Export.ris", ris), ("d/x.txt", "nothing")], "file string, text string")
    out = sorted(rows(exports.collect(df)), key=lambda r: r["ord"])
    assert [r["record_id"] for r in out][:2] == ["WOSA199007", "PM7"] and [r["ord"] for r in out] == [1, 2, 3, 4, 5]
    assert (out[0]["title"], out[0]["year"], out[0]["first_author"], out[0]["doc_types"]) == ("Two parts", "2020", "Lee", ["Article", "Early Access"])
    assert (out[1]["title"], out[1]["doi"], out[1]["language"], out[1]["doc_types"]) == ("A long title", "10.1/q", "eng; ger", ["Letter", "Comment"])
    a, b, c = out[2:]
    assert a["record_id"].startswith("MY_EXPORT-") and b["record_id"] == a["record_id"] + "-2" and c["doc_types"] == ["UNPB"]
    assert (a["abstract"], a["doi"], a["doc_types"], a["year"]) == ("text goes on", "10.1234/zz", ["JOUR", "Letter", "Note"], "1999")
    assert rows(exports.unknown_formats(df)) == [{"file": "d/x.txt"}]
    again = spark.createDataFrame([("a/w.txt", wos), ("z/w.txt", wos + " ")], "file string, text string")
    assert sorted(r["record_id"] for r in rows(exports.collect(again))) == ["WOSA199007", "WOSA199007-2"]


def test_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿record_id,title,abstract\nA,"x ""y""\nz",\nB,t,u\n', encoding="utf-8")
    out = rows(files.read_records(spark, str(tmp_path / "r.csv")))
    assert out == [{"record_id": "A", "title": 'x "y"\nz', "abstract": ""}, {"record_id": "B", "title": "t", "abstract": "u"}]
    (tmp_path / "bad.csv").write_text("record_id,title,abstract\nA,t,u\nA,t,u\n")
    with pytest.raises(ValueError, match="twice"):
        files.read_records(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "ids.txt").write_text("# all\n A \n\nB\nA\n")
    assert sorted(r["record_id"] for r in rows(files.read_id_list(spark, str(tmp_path / "ids.txt")))) == ["A", "B"]
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "A.txt").write_text("one\ntwo")
    assert rows(files.read_full_texts(spark, str(tmp_path / "texts"))) == [{"record_id": "A", "text": "one\ntwo"}]
    (tmp_path / "l.jsonl").write_text('{"b":1,"a":2}\n\n{"a":1}\n{"a":1,"a":2,"b":3}\n')
    got = {r["line"]: r["problem"] for r in rows(files.read_json_lines(spark, str(tmp_path / "l.jsonl"), ("a", "b")))}
    assert got['{"b":1,"a":2}'] is None and got['{"a":1}'] == "other keys" and got['{"a":1,"a":2,"b":3}'] == "duplicate key"
    (tmp_path / "d.csv").write_text("record_id_a,record_id_b,decision\nA,B,maybe\n")
    with pytest.raises(ValueError, match="unknown decisions"):
        files.read_decisions(spark, str(tmp_path / "d.csv"))
    df = spark.createDataFrame([("b", 1), ("a", 2)], "k string, v int")
    files.write_one_csv(df, tmp_path / "o.csv", ["k"])
    assert (tmp_path / "o.csv").read_text() == "k,v\na,2\nb,1\n"
    with pytest.raises(ValueError, match="exists"):
        files.write_one_csv(df, tmp_path / "o.csv", ["k"])
    recorded = files.write_bundle({"one": [1], "two": [{"a": 2}]}, tmp_path / "bundle")
    assert [f["path"] for f in recorded["files"]] == ["results/one.json", "results/two.json"]


LEDGER = "PM1,pubmed,PM1,kept,,,Letter,2001,A title,search/raw/x/a.txt"


@pytest.mark.parametrize("line,reason", [
    (LEDGER, None), ("﻿" + LEDGER + "\r\n", None), (LEDGER.replace("A title", '"A ""t"",\n b"'), None), (LEDGER.replace("A title", '"A'), "quoting"),
    (LEDGER.replace("A title", '"A" b'), "quoting"), (LEDGER.replace("A title", 'A "b"'), "quoting"), (LEDGER + ",x", "columns"), ("", "columns"), (None, "columns"),
    (LEDGER.replace("A title", "A\nb"), "columns"), (LEDGER + "\n" + LEDGER, "columns"), (LEDGER.replace("PM1,pubmed", "PMx,pubmed"), "value"),
    (LEDGER.replace("2001", ""), None), (LEDGER.replace("2001", "201?"), "value"), (LEDGER.replace("kept", "keep"), "value"), (LEDGER.replace("a.txt", "a.doc"), "value"),
    (LEDGER.replace("PM1,pubmed", "ABC-0123456789-2,x"), None), (LEDGER.replace("A title", "x" * 200_000), None),
])
def test_csv_lines(spark, line, reason):
    df = spark.createDataFrame([(1, "ledger", line, "extra"), (2, "ledger", LEDGER, None), (3, "other", LEDGER, None)], "raw_id long, target string, raw_line string, reason string")
    out = {r["raw_id"]: r for r in rows(csv_rows.parse_rows(df))}
    assert out[1]["reason"] == reason and out[2]["reason"] is None and out[3]["reason"] == "columns"
    assert (out[1]["fields"] is None) == (reason is not None)
    loaded = {r["raw_id"]: r for r in rows(csv_rows.load(df, "ledger"))}
    assert set(loaded) == {i for i in (1, 2) if out[i]["reason"] is None} and loaded[2]["record_id"] == "PM1" and loaded[2]["year"] == 2001
    if line == LEDGER.replace("2001", ""):
        assert loaded[1]["year"] is None


def test_the_cell_at_fault_is_named(spark):
    lines = [LEDGER, LEDGER.replace("2001", "201?"), LEDGER.replace("kept", "keep").replace("2001", "x"), LEDGER.replace("PM1,pubmed", "?,pubmed").replace("kept", ""), LEDGER.replace("a.txt", "a"), "x,y"]
    out = rows(csv_rows.parse_rows(spark.createDataFrame([(i, "ledger", x) for i, x in enumerate(lines)], "raw_id long, target string, raw_line string")))
    assert [r["cell"] for r in sorted(out, key=lambda r: r["raw_id"])] == [None, "year", "status", "record_id", "input_file", None]
    import pyarrow as pa

    assert csv_rows._castable(pa.array(["1", "", "99999999999", "x"]), pa.int32()).to_pylist() == [True, True, False, False]


def test_csv_lines_of_an_empty_table(spark):
    assert rows(csv_rows.rejects(spark.createDataFrame([], "raw_id long, target string, raw_line string"))) == []


# ---- screening


CRITERIA = [
    screening.Criterion("C1", any_of=("walking", "dance"), any_of_regex=(r"tai(?P<gap>.{0,3})chi",)),
    screening.Criterion("C2", none_of=("protocol",), title_none_of=("reply",)),
    screening.Criterion("C3", field="language", field_any_of=("eng",)),
    screening.Criterion("C4", any_of=("full",), check_at=("ft",)),
]


def test_screening(spark):
    df = spark.createDataFrame([
        ("A", "Walking", "for all", "eng"), ("B", "Sleepwalking", "no hit", ""), ("C", "Dance’s PROTOCOL", "x", "eng"), ("D", "A", "tai - chi reply", "eng"),
        ("E", "Reply", "walking", "ger"), ("F", "any", " ", None), ("G", None, "dance", None),
    ], "record_id string, title string, abstract string, language string")
    out = {r["record_id"]: r for r in rows(screening.screen(df, CRITERIA, "ta", "v1"))}
    assert {k: r["failed_criteria"] for k, r in out.items()} == {"A": "", "B": "C1", "C": "C2", "D": "", "E": "C2;C3", "F": "", "G": ""}
    assert out["F"]["reason"] == screening.NO_ABSTRACT and out["F"]["criteria"] == {} and set(out["A"]["criteria"]) == {"C1", "C2", "C3"}
    assert out["E"]["reason"] == "failed C2, C3"
    ev = {(r["record_id"], r["criterion"]): r for r in rows(screening.evidence(df, CRITERIA, "ta"))}
    assert ev["A", "C1"]["evidence"][0]["term"] == "walking" and ev["E", "C3"]["evidence"] == [{"term": "language", "snippet": "ger"}] and ev["E", "C2"]["evidence"][0]["snippet"] == "reply"
    with pytest.raises(ValueError, match="lack"):
        screening.screen(df.drop("language"), CRITERIA, "ta", "v1")
    with pytest.raises(ValueError):
        screening.check_tables(CRITERIA, CRITERIA[:2])
    assert [r["record_id"] for r in rows(screening.near_misses(screening.screen(df, CRITERIA, "ta", "1")))] == ["B", "C"]


def test_between_phases(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "record_id string")
    decided = spark.createDataFrame([("A", "keep"), ("B", "exclude"), ("C", "keep"), ("X", "keep")], "record_id string, decision string")
    assert {(r["record_id"], r["side"]) for r in rows(screening.coverage_gaps(ids("A", "B", "C", "D"), decided))} == {("D", "undecided"), ("X", "unknown")}
    got = screening.full_text_input(ids("A", "B", "C"), decided, ids("B"), ids("C"))
    assert sorted(r["record_id"] for r in rows(got)) == ["A", "B"]
    wrong = screening.list_errors(ids("A", "B", "C"), decided.where("record_id <> 'X'"), ids("A", "Z"), ids("C", "B"), ids("C"))
    assert {(r["record_id"], r["error"]) for r in rows(wrong)} == {
        ("Z", "added but unknown"), ("A", "added but kept already"), ("B", "not retrieved but not kept"), ("C", "not retrieved but has a text"), ("A", "text missing"), ("Z", "text missing"),
    }


# ---- audits


def test_attempts(spark):
    df = spark.createDataFrame([("a", 1, "Technical_Error"), ("a", 2, "response "), ("b", 1, "response"), ("b", 3, "response"), ("c", 1, "response"), ("c", 2, "response"), ("d", 1, "odd")], "request_id string, attempt int, kind string")
    log = audit.attempt_log(df, (F.col("attempt") == 2) | (F.col("request_id") == "c"))
    out = {(r["request_id"], r["attempt"]): (r["status"], r["problem"]) for r in rows(log)}
    assert out["a", 1] == ("TECHNICAL_FAILURE", None) and out["a", 2] == ("VALID", None) and out["b", 3][1] == "attempts are not 1 to n"
    assert out["c", 2][1] == "attempt after a valid one" and out["d", 1][1] == "unknown kind"
    assert {r["request_id"]: r["accepted"] for r in rows(audit.resolved(log))} == {"a": 2, "b": None, "c": 1, "d": None}
    gaps = audit.request_gaps(spark.createDataFrame([("a",), ("z",)], "request_id string"), df)
    assert {(r["request_id"], r["problem"]) for r in rows(gaps)} == {("z", "unused request"), ("b", "unknown request"), ("c", "unknown request"), ("d", "unknown request")}


def test_votes_and_revision(spark):
    votes = spark.createDataFrame([(s, w, d) for s, ds in {"p": "ie", "q": "iie", "r": "ee", "s": "iei", "t": "ii"}.items() for w, d in zip(["a1", "a2", "third"], [{"i": "include", "e": "exclude"}[x] for x in ds])], "source_id string, reviewer string, decision string")
    out = {r["source_id"]: (r["majority"], r["route"]) for r in rows(audit.routed_votes(votes))}
    assert out == {"p": ("exclude", "third"), "q": ("include", "human"), "r": ("exclude", "done"), "s": ("include", "human"), "t": ("include", "human")}
    human = spark.createDataFrame([("q", "include"), ("s", "exclude"), ("r", "include")], "source_id string, decision string")
    final = {r["source_id"]: (r["final"], r["problem"]) for r in rows(audit.confirmed(audit.routed_votes(votes), human))}
    assert final["q"] == ("include", None) and final["s"] == ("exclude", None) and final["r"][1] == "unused adjudication" and final["t"][1] == "adjudication missing"
    cand = spark.createDataFrame([("q", "yoga"), ("r", "chess")], "source_id string, kind string")
    rules = spark.createDataFrame([("1", ["walk"]), ("2", ["walk", "yoga"])], "version string, kinds array<string>")
    screened = audit.rule_versions(cand, rules, F.array_contains("kinds", F.col("kind")))
    one = lambda *x: spark.createDataFrame([(i,) for i in x], "source_id string")
    assert rows(audit.revision_errors(screened, one("q"), one("q"), "1"))[0]["problem"] == "confirmed miss still excluded"
    assert rows(audit.revision_errors(screened, one("q"), one("q"), "2")) == [{"source_id": "r", "problem": "exclusion without an audit"}]


def test_challenges(spark):
    c = spark.createDataFrame([("1", "sd", "1.58", "10.0"), ("2", "sd", "5", "6"), ("3", "sd", "5", "6"), ("4", "sd", "5", "6")], "Row_UID string, field string, current string, proposed string")
    a = spark.createDataFrame([("1", "sd", "10"), ("2", "sd", "5.0"), ("3", "sd", "7")], "Row_UID string, field string, value string")
    out = audit.routed_challenges(c, a)
    assert {r["Row_UID"]: r["outcome"] for r in rows(out)} == {"1": "correction", "2": "rejected", "3": "needs_human", "4": "needs_human"}
    coded = spark.createDataFrame([("1", 1.58, "x"), ("2", 5.0, "y")], "Row_UID string, sd double, note string")
    fixed = audit.reconciled(coded, out.where("outcome = 'correction'"), ["sd", "note"])
    assert sorted((r["Row_UID"], r["sd"], r["note"]) for r in rows(fixed)) == [("1", 10.0, "x"), ("2", 5.0, "y")]


def test_seeded_rounds(spark):
    df = spark.range(100).withColumn("s", F.col("id") % 2)
    first, second = (rows(audit.seeded_sample(df, "id", ["s"], "x", a, b)) for a, b in ((1, 10), (11, 20)))
    assert len(first) == len(second) == 20 and not {r["id"] for r in first} & {r["id"] for r in second}
    t = spark.createDataFrame([("n", 1, 10, 1), ("n", 2, 10, 0), ("n", 3, 10, 0)], "stratum string, round int, audited int, missed int")
    assert [(r["audited_so_far"], r["may_stop"]) for r in sorted(rows(audit.round_totals(t)), key=lambda r: r["round"])] == [(10, False), (20, False), (30, True)]


def test_registry(spark):
    empty = spark.createDataFrame([], "row_uid string, identity map<string,string>, status string")
    req = lambda *x: spark.createDataFrame(x, "study string, arm string, k int")
    one = registry.register(req(("S1", "t", 2), ("S1", "c", 1)), empty, ["study", "arm"], "TEST", "k")
    assert {r["identity"]["arm"]: r["row_uid"] for r in rows(one)} == {"c": "TEST-R000001", "t": "TEST-R000002"}
    two = registry.register(req(("S1", "t", 1), ("S2", "t", 2)), registry.retire(one, spark.createDataFrame([("TEST-R000001",)], "row_uid string")), ["arm", "study"], "TEST", "k")
    assert {(r["row_uid"], r["status"]) for r in rows(two)} == {("TEST-R000001", "retired"), ("TEST-R000002", "active"), ("TEST-R000003", "active")}
    found = {(r["study"], r["arm"]): (r["row_uid"], r["problem"]) for r in rows(registry.lookup(req(("S1", "c", 0), ("S2", "t", 0), ("S2 ", "t", 0)), two, ["study", "arm"]))}
    assert found == {("S1", "c"): ("TEST-R000001", "retired"), ("S2", "t"): ("TEST-R000003", None), ("S2 ", "t"): (None, "unregistered")}
    assert rows(registry.problems(two, ["study", "arm"], "TEST", 4)) == []
    assert {r["problem"] for r in rows(registry.problems(two, ["study", "arm"], "TEST", 3))} == {"id not below the counter"}
    assert {r["problem"] for r in rows(registry.request_problems(req(("S1", "c", 1), ("S9", "x", 1), ("S9", "x", 2)), two, ["study", "arm"]))} == {"retired", "requested twice"}


# ---- codebook


def book(**change):
    var = lambda name, type_, **k: {"name": name, "type": type_, "nullable": False, "owner": "executor", "description": "d", "rule": "r", "source_rule": "s", "missing_rule": "m", "counterexample": "c", "example": "e", **k}
    variables = [var("Study", "string"), var("N", "integer", nullable=True, minimum=2, example=5), var("Arm", "string", allowed_values=["t", "c"], example="t"), var("g", "number", owner="code", nullable=True, example=None)]
    out = {
        "schema_version": "codebook/1", "project": {"id": "p", "title": "t", "question": "q", "domain": "d"}, "version": "1", "status": "ready",
        "approval": {"by": "x", "date": "2024-01-31", "basis": "y"}, "unit": {"record": "r", "study": "s", "row": "r", "independent_unit": "i", "identity_fields": ["Study", "Arm"]},
        "eligibility": {"file": "eligibility.json", "sha256": ""}, "variables": variables, "columns": [v["name"] for v in variables], "provenance_fields": ["Study"],
        "outcome_map": [1], "pairing_rule": "p", "aggregation_rule": "a", "direction_rule": "d", "source_precedence": ["x"], "unresolved_policy": "u", "worked_cases": [1],
    }
    return out | change


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "eligibility.json").write_bytes(b'{"version":"1","mixed_condition_rule":"m","criteria":[{"id":"C1","text":"t","clarifications":["x"]}]}\r\n')
    return tmp_path


def write_book(folder, cb):
    cb["eligibility"]["sha256"] = cb["eligibility"]["sha256"] or provenance.digest(folder / "eligibility.json")
    (folder / "codebook.json").write_text(json.dumps(cb))
    return codebook.check_codebook(folder / "codebook.json", ready=True)


def test_a_good_codebook(folder):
    found = write_book(folder, book())
    assert found.passed, found
    assert codebook.schema(book())["N"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("change", [
    {"status": "draft"}, {"columns": ["Study"]}, {"outcome_map": []}, {"schema_version": "x"}, {"provenance_fields": ["no"]}, {"version": "TODO"},
    {"approval": {"by": "x", "date": "2024-1-31", "basis": "y"}}, {"eligibility": {"file": "../e.json", "sha256": "x"}}, {"eligibility": {"file": "eligibility.json", "sha256": "0" * 64}}, {"project": None},
])
def test_bad_codebooks(folder, change):
    assert not write_book(folder, book(**change)).passed


def test_bad_variables(folder):
    for i, key, value in ((1, "minimum", "x"), (0, "nullable", True), (3, "owner", "executor"), (2, "allowed_values", []), (1, "example", 1), (0, "type", "text"), (0, "name", "a b")):
        cb = book()
        cb["variables"][i][key] = value
        assert not write_book(folder, cb).passed, key


def test_rows_against_a_codebook(spark):
    cases = [('{"Study":"S","N":40,"Arm":"t"}', []), ('{"Study":"S","N":40.0,"Arm":"c"}', ["N is no integer"]), ('{"Study":"S","N":1,"Arm":"x"}', ["N is below 2", "Arm is none of the listed values"]),
             ('{"Study":"S","N":null,"Arm":"t"}', ["another row has this identity"]), ('{"Study":null,"N":null,"Arm":"t"}', ["Study is empty"]), ('{"Study":"S"}', ["the fields are not those of the executor"]), ("{", None)]
    out = {r["row_id"]: r["errors"] for r in rows(codebook.validate_rows(spark.createDataFrame(list(enumerate(c[0] for c in cases)), "row_id long, row string"), book()))}
    for i, (_, errors) in enumerate(cases):
        assert (out[i] == errors) if errors is not None else out[i][0].startswith("no strict JSON")
    assert codebook.path_error({"ES_Path": "means_sd", "events": 1}) and codebook.path_error({"ES_Path": "events_total", "events": 3, "total": 2}) and not codebook.path_error({"ES_Path": "events_total", "events": 3, "total": 4})


def test_evidence(spark):
    src = spark.createDataFrame([("s", "Study-ID: A\r\nVersion: 1\nthe quick brown fox jumps over"), ("t", "Study-ID: A\nStudy-ID: B\nVersion: 2"), ("u", "Version: 2")], "source_id string, text string")
    q = spark.createDataFrame([("s", 3, "brown fox"), ("s", 1, "brown"), ("s", 9, "x"), ("z", 1, "x"), ("s", 1, ""), ("s", 0, "x")], "source_id string, line long, quote string")
    assert [r["problem"] for r in sorted(rows(evidence.check_quotes(q, src)), key=lambda r: (r["source_id"], r["line"], r["quote"]))] == ["line out of range", "empty quote", "not on this line", None, "line out of range", "unknown source"]
    assert {r["source_id"]: r["problem"] for r in rows(evidence.headers(src, ["Study-ID", "Version"]))} == {"s": None, "t": "repeated header", "u": "missing header"}
    loc = spark.createDataFrame([("s", "the quick brown fox leaps over"), ("s", "one two three")], "source_id string, quote string")
    assert [r["found"] for r in rows(evidence.locate_quotes(loc, src, 0.3))] == [True, False]


# ---- effects


def coded(spark, data):
    return spark.createDataFrame(data, "Study_ID string, Condition_ID string, Outcome_Metric string, Arm string, ES_Path string, N double, mean double, sd double, events double, total double, Row_UID string")


def test_pairs_to_effects(spark):
    df = coded(spark, [
        ("A", "1", "s", "treatment", "means_sd", 40.0, 65.0, 10.0, None, None, "1"), ("A", "1", "s", "comparator", "means_sd", 40.0, 60.0, 10.0, None, None, "2"),
        ("B", "1", "s", "treatment", "events_total", None, None, None, 0.0, 10.0, "3"), ("B", "1", "s", "comparator", "events_total", None, None, None, 5.0, 10.0, "4"),
        ("C", "1", "s", "treatment", "means_sd", 40.0, 65.0, None, None, None, "5"), ("C", "1", "s", "comparator", "means_sd", 40.0, 60.0, 10.0, None, None, "6"),
        ("D", "1", "s", "treatment", "means_sd", 40.0, 65.0, 1.0, None, None, "7"),
    ])
    pairs = effects.paired(df)
    assert [r["Study_ID"] for r in rows(pairs.where("problem IS NOT NULL"))] == ["D"]
    good = pairs.where("problem IS NULL")
    assert {r["Study_ID"]: [m["field"] for m in r["missing"]] for r in rows(effects.computability(good))} == {"A": [], "B": [], "C": ["sd"]}
    out = {r["Study_ID"]: r for r in rows(effects.effects(good))}
    assert set(out) == {"A", "B"} and math.isclose(out["A"]["g"], 0.49517684887459806, rel_tol=1e-12) and out["B"]["continuity_correction"] and out["B"]["method"] == "log_or_derived_g"
    assert {r["method"] for r in rows(effects.pooled(effects.effects(good)))} == {"pooled_sd_hedges_g", "log_or_derived_g"}


def test_dispersion_against_a_model(spark):
    rng = random.Random(3)
    data = [(f"R{i}", f"S{rng.randint(0, 5)}", f"o{rng.randint(0, 2)}", str(rng.choice([1, 2, 9, 40, 100])), rng.choice(["", "x", "0", str(round(rng.lognormvariate(0, 1.2), 4)), str(round(rng.lognormvariate(0, 1.2), 4))])) for i in range(150)]
    data += [("RB", "S9", "o0", "36", "0.17"), ("RC", "S8", "o9", "36", "0.17")]

    def value(x):
        try:
            return float(x) if float(x) > 0 else None
        except ValueError:
            return None

    expected = set()
    for uid, s, o, n, sd in data:
        sd = value(sd)
        if sd is None:
            continue
        by = {}
        for u2, s2, o2, _, sd2 in data:
            if o2 == o and value(sd2):
                by.setdefault(s2, []).append((u2, value(sd2)))
        own = [v for u, v in by[s] if u != uid]
        if own and sd < max(own) / 3:
            expected.add((uid, "A"))
            continue
        others = [statistics.median([v for _, v in vs]) for k, vs in by.items() if k != s]
        if others and float(n) >= 2:
            typical = statistics.median(others)
            if sd < typical / 3 and abs(math.log(sd * math.sqrt(float(n)) / typical)) < abs(math.log(sd / typical)):
                expected.add((uid, "B"))
    df = spark.createDataFrame(data, "Row_UID string, Study_ID string, Outcome_Metric string, N string, sd string")
    assert {(r["Row_UID"], r["rule"]) for r in rows(effects.dispersion_flags(df))} == expected and {r for _, r in expected} == {"A", "B"}
    for ratio in (1, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            effects.dispersion_flags(df, ratio)


def test_lookups(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", None)], "k string, value double")
    b = spark.createDataFrame([("y", 2.0), ("x", 9.0)], "k string, value double")
    out = lookup.priority_lookup(spark.createDataFrame([("x",), ("y",), ("z",)], "k string"), [(a, ["k"]), (b, ["k"])], "value")
    assert {r["k"]: (r["value"], r["level"]) for r in rows(out)} == {"x": (1.0, 1), "y": (2.0, 2), "z": (None, None)}
    r = spark.createDataFrame([("S", "a", "preprint"), ("S", "b", "journal"), ("S", "c", "journal"), ("T", "d", None)], "Study_ID string, source_id string, version string")
    assert {x["source_id"] for x in rows(lookup.representatives(r)) if x["representative"]} == {"c", "d"}
    p = spark.createDataFrame([("a", ["Lee", "Fox"], "Walking and mood in groups", 100), ("b", ["lee ", "Kim"], "Walking and mood", 50), ("c", ["Kim"], "Chess", 10), ("d", None, None, None)], "source_id string, authors array<string>, title string, length int")
    assert [(x["a"], x["b"]) for x in rows(lookup.same_study_pairs(p))] == [("a", "b")]
    c = spark.createDataFrame([("e", "1", 5), ("e", "2", 6)], "entity string, cache_version string, v int")
    assert [x["v"] for x in rows(lookup.cached_attributes(spark.createDataFrame([("e",), ("f",)], "entity string"), c, "2"))] == [6, None]
    assert rows(lookup.by_unit(spark.createDataFrame([("u", 1.0), ("u", 3.0)], "k string, x double"), ["k"], ["x"])) == [{"k": "u", "n_rows": 2, "x": 2.0}]


# ---- provenance


def test_manifests_and_releases(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("a")
    (tmp_path / "b.txt").write_text("b")
    recorded = provenance.freeze(tmp_path, ["b.txt"], ["in"], "MANIFEST.json")
    assert provenance.verify(tmp_path, recorded) == []
    assert [(r["path"], r["size"]) for r in rows(provenance.manifest(spark, str(tmp_path / "in")))] == [("a.txt", 1)]
    (tmp_path / "in" / "c.txt").write_text("c")
    (tmp_path / "in" / "a.txt").write_text("x")
    (tmp_path / "b.txt").unlink()
    assert provenance.verify(tmp_path, recorded) == [("b.txt", "missing"), ("in/a.txt", "changed"), ("in/c.txt", "added")]
    for bad in ("../x", "/x", "a//b", "a\\b", "c:x", ""):
        with pytest.raises(ValueError):
            provenance.safe_path(tmp_path, bad)
    with pytest.raises(ValueError):
        provenance.freeze(tmp_path, [], ["in"], "in/M.json")
    entry = recorded["files"][0]
    for wrong in ({"schema_version": 2}, {"schema_version": True}, {"files": []}, {"files": [entry, entry]}, {"files": [entry | {"sha256": "x"}]}, {"files": [entry | {"size": -1}]}, {"files": ["x"]}, {"scopes": ["gone"]}, {"scopes": "in"}, {"more": 1}):
        with pytest.raises(ValueError):
            provenance.verify(tmp_path, recorded | wrong)
    (tmp_path / "in" / "l").symlink_to(tmp_path / "in" / "c.txt")
    assert ("in/l", "link") in provenance.verify(tmp_path, recorded)
    with pytest.raises(ValueError):
        provenance.safe_path(tmp_path, "in/l")
    with pytest.raises(ValueError):
        provenance.freeze(tmp_path, [], ["in"], "M2.json")
    r = provenance.Releases(tmp_path)
    r.create("v1")
    r.activate("v1")
    assert r.current() == "v1"
    (tmp_path / "releases" / "v1" / "files" / "MANIFEST.json").write_text("x")
    with pytest.raises(ValueError):
        r.activate("v1")
    with pytest.raises(ValueError):
        r.create("v1")


def test_stages(tmp_path):
    formal = tmp_path / "formal"
    formal.mkdir()
    (formal / "one").write_text("1")
    (formal / "two").write_text("2")
    put = lambda name, value: lambda out: provenance.write_new(out / name, value)
    stages = [provenance.Stage("a", put("one", "1"), ["one"]), provenance.Stage("b", put("two", "x"), ["two"]), provenance.Stage("c", put("three", ""), [])]
    assert [s["status"] for s in provenance.run_stages(stages, tmp_path, formal, tmp_path / "run")] == ["equal", "differs"]
    with pytest.raises(ValueError):
        provenance.run_stages(stages, tmp_path, formal, tmp_path / "run")
    provenance.record_outputs(formal, ["one"], tmp_path / "rec.json")
    provenance.record_outputs(formal, ["two"], tmp_path / "rec.json")
    assert len(list(tmp_path.glob("rec*.json"))) == 2


def test_comparisons_of_manifests(spark):
    df = lambda *x: spark.createDataFrame(x, "path string, sha256 string")
    assert {(r["path"], r["change"]) for r in rows(provenance.compare(df(("a", "1"), ("b", "2"), ("c", "3")), df(("a", "1"), ("b", "x"), ("d", "4"))))} == {("b", "changed"), ("c", "missing"), ("d", "added")}
    st = provenance.template_status(df(("a", "1"), ("b", "9"), ("c", "3")), df(("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")), df(("a", "1"), ("b", "2"), ("c", "5"), ("d", "4")))
    assert {r["path"]: r["status"] for r in rows(st)} == {"a": "current", "b": "filled", "c": "outdated", "d": "missing"}


# ---- whole paths


def test_flow(spark):
    rec = spark.createDataFrame([("r1", "s1", "k1", "Walking", "text", 1), ("r2", "s2", "k1", "Walking", "text", 2), ("r3", "s3", "k2", "Dance", "t", 3), ("r4", "s4", "k3", "Chess", "t", 4), ("r5", "s5", "k4", "walking yoga", "t", 5)], "record_id string, source_id string, source_key string, title string, abstract string, ord int")
    texts = spark.createDataFrame([("s1", "walk"), ("s3", "dance"), ("s5", "yoga")], "source_id string, kind string")
    rules = spark.createDataFrame([("1", ["walk", "dance"]), ("2", ["walk", "dance", "yoga"])], "version string, kinds array<string>")
    votes = spark.createDataFrame([("s5", "auditor_1", "include"), ("s5", "auditor_2", "exclude"), ("s5", "third", "include")], "source_id string, reviewer string, decision string")
    human = spark.createDataFrame([("s5", "include")], "source_id string, decision string")
    t = flow.flow(rec, [screening.Criterion("C1", any_of=("walking", "dance"))], texts, rules, F.array_contains("kinds", F.col("kind")), votes, human)
    n = rows(flow.flow_counts(t, "2"))[0]
    assert n == {"duplicates": 1, "screened_records": 4, "first_phase_excluded": 1, "full_texts_assessed": 3, "full_text_excluded": 0, "included_reports": 3, "confirmed_misses": 1, "search_records": 5, "balanced": True}


def test_stream_of_attempts(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "technical_error", None, "2024-01-01 00:00:10"), ("a", 2, "response", "yes", "2024-01-01 00:30:00"), ("a", 2, "response", "yes", "2024-01-01 00:30:01"), ("b", 1, "response", "", "2024-01-01 05:00:00")], "request_id string, attempt int, kind string, raw_text string, received_at string")
    df.withColumn("received_at", F.col("received_at").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    done = attempts.run_to_end(attempts.running_attempts(stream(), F.coalesce("raw_text", F.lit("")) != ""), "complete")
    assert {r["request_id"]: (r["attempts"], r["technical_failures"], r["accepted"]) for r in rows(done)} == {"a": (3, 1, 2), "b": (1, 0, None)}
    wins = attempts.run_to_end(attempts.arrivals(stream()), "append")
    assert {(r["status"], r["n"]) for r in rows(wins)} == {("TECHNICAL_FAILURE", 1), ("VALID", 1)}


# ---- answers


PAPER = {"source_id": "S1", "text": "Population: adults\nTreatment: N = 20, mean 5.5, sd 1.5\nComparator: N = 22, mean 4.5, sd 1.0"}
QUOTE = {"source_id": "S1", "line": 2, "quote": "N = 20"}


@pytest.mark.parametrize("change,fault", [
    ({}, None), ({"decision": "maybe"}, "no decision"), ({"criterion_ids": []}, "unknown criteria"), ({"criterion_ids": ["C9"]}, "unknown criteria"), ({"more": 1}, "other keys"), ({"rationale": "r"}, None),
    ({"evidence": QUOTE | {"line": 1}}, "quotation not on its line"), ({"evidence": QUOTE | {"line": 9}}, "line out of range"), ({"evidence": QUOTE | {"line": True}}, "line out of range"),
    ({"evidence": QUOTE | {"source_id": "S2"}}, "quotation of another source"), ({"evidence": None}, "no quotation"), ({"evidence": QUOTE | {"quote": ""}}, "quotation not on its line"),
])
def test_screening_answers(change, fault):
    answer = {"decision": "include", "criterion_ids": ["C1"], "evidence": QUOTE} | change
    assert next(answers.screening_answer({"C1", "C2"}, ("rationale",))(answer, {"sources": [PAPER]}), None) == fault


def coding_book():
    var = lambda n, t, **k: {"name": n, "type": t, "nullable": True, "owner": "executor", **k}
    names = [var("Study_ID", "string", nullable=False), var("Arm", "string", nullable=False), var("ES_Path", "string"), *[var(n, "number", minimum=0) for n in ("N", "mean", "sd", "events", "total")]]
    return {"variables": names, "unit": {"identity_fields": ["Study_ID", "Arm"]}}


def coded_arm(arm, **change):
    return {"Study_ID": "A", "Arm": arm, "ES_Path": "means_sd", "N": 20, "mean": None, "sd": None, "events": None, "total": None} | change


@pytest.mark.parametrize("change,fault", [
    ({}, None), ({"rows": [coded_arm("treatment")]}, "not one row of each arm"), ({"rows": [coded_arm("treatment", Study_ID="B"), coded_arm("comparator")]}, "a row of another study"),
    ({"rows": [coded_arm("treatment", events=1), coded_arm("comparator")]}, "inputs of events_total given"), ({"rows": [coded_arm("treatment", N="x"), coded_arm("comparator")]}, "N is no number"), ({"warnings": None}, "other keys"),
    ({"evidence": []}, "evidence and numbers differ"), ({"evidence": [{"Arm": "treatment", "field": "N", "source": QUOTE}] * 2}, "evidence and numbers differ"), ({"evidence": [{"Arm": "x"}]}, "evidence for no field"),
])
def test_coding_answers(change, fault):
    good = {"rows": [coded_arm("treatment"), coded_arm("comparator", N=None)], "evidence": [{"Arm": "treatment", "field": "N", "source": QUOTE}], "unresolved_items": [], "skipped_conditions": [], "warnings": []}
    request = {"study_id": "A", "source_id": "S1", "sources": [PAPER]}
    assert next(answers.coding_answer(coding_book())(good | change, request), None) == fault


CHALLENGE = {"Row_UID": "R1", "field": "mean", "proposed": 5.5, "rule": "U1", "evidence": QUOTE}


@pytest.mark.parametrize("change,fault", [
    ({}, None), ({"status": "PASS", "challenges": []}, None), ({"status": "PASS"}, "status and challenges differ"), ({"checked_rows": ["R1"]}, "other rows"), ({"checked_rows": ["R1", "R1"]}, "other rows"),
    ({"domains": []}, "other domains"), ({"challenges": [CHALLENGE, CHALLENGE]}, "a value challenged twice"), ({"challenges": [CHALLENGE | {"field": "Arm"}]}, "a challenge of what is fixed"),
    ({"challenges": [CHALLENGE | {"proposed": "x"}]}, "mean is no number"), ({"challenges": [CHALLENGE | {"rule": "U9"}]}, "an unknown rule"), ({"challenges": [{}]}, "no challenge"), ({"x": 1}, "other keys"),
])
def test_audit_answers(change, fault):
    good = {"status": "CHALLENGE", "checked_rows": ["R2", "R1"], "domains": ["values"], "challenges": [CHALLENGE]}
    request = {"targets": [{"Row_UID": "R1"}, {"Row_UID": "R2"}], "sources": [PAPER]}
    assert next(answers.audit_answer(coding_book(), ["values"], {"U1"})(good | change, request), None) == fault


def test_checked_attempts_and_blinding(spark):
    request = json.dumps({"sources": [PAPER], "text": 'says "decision": x'})
    good = json.dumps({"decision": "include", "criterion_ids": ["C1"], "evidence": QUOTE})
    data = [("a", 1, "response", "{"), ("a", 2, "response", good), ("b", 1, "response", good), ("c", 1, "response", None), ("d", 1, "response", '{"decision": 1, "decision": 2}')]
    attempts = spark.createDataFrame(data, "request_id string, attempt int, kind string, raw_text string")
    requests = spark.createDataFrame([("a", request), ("c", request), ("d", request)], "request_id string, request string")
    out = {(r["request_id"], r["attempt"]): r["problem"] for r in rows(answers.checked(attempts, requests, answers.screening_answer({"C1"})))}
    assert out == {("a", 1): "no object", ("a", 2): None, ("b", 1): "no request", ("c", 1): "no object", ("d", 1): "no object"}
    assert rows(answers.checked(attempts.limit(0), requests, answers.screening_answer({"C1"}))) == []
    shown = [r["s"] for r in rows(requests.limit(1).select(answers.shows(requests["request"], ["decision", "text"]).alias("s")))]
    assert shown == ["text"]
    assert answers.blinded(attempts, ["request_id", "attempt"]).columns == ["request_id", "attempt"]
    with pytest.raises(Exception):
        answers.blinded(attempts, ["effect"])


def test_registry_refuses(spark):
    empty = spark.createDataFrame([], "row_uid string, identity map<string,string>, status string")
    req = lambda *x: spark.createDataFrame(x, "study string, k int")
    with pytest.raises(ValueError, match="twice"):
        registry.register(req(("S", 1), ("S", 2)), empty, ["study"], "TEST", "k")
    one = registry.register(req(("S", 1)), empty, ["study"], "TEST", "k")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "row_uid string")
    gone = registry.retire(one, ids("TEST-R000001"))
    for wrong in ("TEST-R000001", "TEST-R000009"):
        with pytest.raises(ValueError, match="not active"):
            registry.retire(gone, ids(wrong))
    with pytest.raises(ValueError, match="retired"):
        registry.register(req(("S", 1)), gone, ["study"], "TEST", "k")
    found = files_check.credentials(spark.createDataFrame([("a", "sk-proj-" + "a" * 40), ("b", "sk-short"), ("c", "ghp_" + "b" * 36)], "path string, text string"))
    assert {r["path"]: r["kind"] for r in rows(found)} == {"a": "service key", "c": "code host token"}


def test_suffixes_look_for_a_free_number(spark):
    data = [("f1", 1, "X"), ("f1", 2, "X-2"), ("f1", 3, "X"), ("f2", 1, "X"), ("f2", 2, "Y"), ("f2", 3, "Y"), ("f3", 1, "X-2")]
    out = rows(exports.unique_ids(spark.createDataFrame(data, "file string, block int, record_id string")))
    assert {(r["file"], r["block"]): r["record_id"] for r in out} == {
        ("f1", 1): "X", ("f1", 2): "X-2", ("f1", 3): "X-3", ("f2", 1): "X-4", ("f2", 2): "Y", ("f2", 3): "Y-2", ("f3", 1): "X-2-2",
    }


def test_hot_blocks_are_dealt_to_tasks(spark):
    from evspark.runtime import pairs_within

    df = spark.createDataFrame([("hot", f"v{i:03d}") for i in range(120)] + [(f"c{i}", "v") for i in range(120)], "k string, v string")
    out = pairs_within(df, ["k"], "v", 10)
    assert out.count() == 120 * 119 // 2 and out.where("v_a >= v_b").isEmpty()
