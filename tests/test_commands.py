import csv
import json
import math

import pytest

from evspark.__main__ import main
from evspark.functions import sqlfunctions
from evspark.operators import files_check
from evspark.sources import connector


MEDLINE = """PMID- 501
TI  - Bright light in the morning for tired crews
      of night trains
DP  - 2003 Feb
PT  - Journal Article

PMID- 502
TI  - Naps
LID - 10.5555/m1 [doi]
DP  - 2004

PMID- 503
TI  - From the desk
PT  - Editorial
DP  - 2004

PMID- 504
TI  - Quiet rooms and the mood of nurses on wards
DP  - 2005
"""
WOS = "FN An Export\nVR 1.0\n" + "".join(
    f"PT J\nTI {title}\n{more}PY {year}\nUT WOS:{ut}\nER\n\n"
    for ut, title, year, more in (
        ("A1", "Light", 2003, "PM 501\n"), ("A2", "On naps", 2004, "DI 10.5555/M1\n"), ("A3", "Quiet rooms and the mood of nurses -\n   on wards", 2005, ""), ("A4", "Quiet rooms and the mood of nurses on wards", 2006, ""),
    )
) + "EF\n"


def read(path):
    with path.open(encoding="utf-8", newline="") as f:
        return list(csv.DictReader(f))


@pytest.fixture
def inputs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "pubmed.txt").write_text("﻿" + MEDLINE, encoding="utf-8")
    (tmp_path / "in" / "wos.txt").write_bytes(WOS.replace("\n", "\r\n").encode())
    rules = {"min_title_words": 6, "similarity_threshold": 0.9, "source_precedence": ["pubmed", "wos"], "report_version_labels": ["Preprint"],
             "doc_type_removal": {"listed": {"pubmed": ["Editorial"]}, "neutral": {"default": ["Journal *"]}}}
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    return tmp_path


def test_dedupe(inputs):
    args = ["dedupe", "--inputs", str(inputs / "in" / "wos.txt"), str(inputs / "in" / "pubmed.txt"), "--rules", str(inputs / "rules.json"), "--output"]
    assert main([*args, str(inputs / "out")]) == 0
    summary = json.loads((inputs / "out" / "summary.json").read_text())
    assert summary["status"] == "pending" and summary["counts"]["records_passed_to_screening"] == 4 and [i["records"] for i in summary["inputs"]] == [4, 4]
    assert len(read(inputs / "out" / "records.csv")) == 4 and len(read(inputs / "out" / "ledger.csv")) == 8
    assert [r["pair_id"] for r in read(inputs / "out" / "review_pairs.csv")] == ["P001"]
    assert main([*args, str(inputs / "out")]) == 2
    (inputs / "in" / "again.txt").write_text("﻿" + MEDLINE, encoding="utf-8")
    assert main(["dedupe", "--inputs", *[str(inputs / "in" / n) for n in ("pubmed.txt", "again.txt")], "--rules", str(inputs / "rules.json"), "--output", str(inputs / "o2")]) == 2
    (inputs / "d.csv").write_text("record_id_a,record_id_b,decision,note\nPM504,WOSA3,not_duplicate,x\n")
    assert main([*args, str(inputs / "o3"), "--decisions", str(inputs / "d.csv")]) == 1
    (inputs / "d.csv").write_text("record_id_a,record_id_b,decision,note\nPM504,nobody,duplicate,x\n")
    assert main([*args, str(inputs / "o4"), "--decisions", str(inputs / "d.csv")]) == 2


def test_screen_in_two_phases(spark, tmp_path):
    (tmp_path / "r.csv").write_text("record_id,title,abstract\nA,Walking,for all\nB,Chess,for all\nC,Dance,\n")
    (tmp_path / "c.json").write_text(json.dumps({"version": "1", "criteria": [{"id": "C1", "any_of": ["walking", "dance"], "check_at": ["ta", "ft"]}]}))
    base = ["screen", "ta", str(tmp_path / "r.csv"), "--criteria", str(tmp_path / "c.json"), "--output"]
    assert main([*base, str(tmp_path / "ta")]) == 0
    assert {r["record_id"]: r["decision"] for r in read(tmp_path / "ta" / "decisions.csv")} == {"A": "keep", "B": "exclude", "C": "keep"}
    assert json.loads((tmp_path / "ta" / "summary.json").read_text())["decisions"] == {"keep": 2, "exclude": 1}
    told = {r["record_id"]: r["criteria"] for r in spark.read.json(str(tmp_path / "ta" / "evidence.json")).collect()}
    assert told["A"][0]["evidence"][0]["term"] == "walking" and not told["B"][0]["supported"]
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "A.txt").write_text("about nothing")
    ft = ["screen", "ft", str(tmp_path / "r.csv"), "--criteria", str(tmp_path / "c.json"), "--after-ta", str(tmp_path / "ta"), "--texts", str(tmp_path / "texts"), "--output"]
    assert main([*ft, str(tmp_path / "x")]) == 2  # a text is missing
    (tmp_path / "nr.txt").write_text("C\n")
    (tmp_path / "add.txt").write_text("# after the audit\nB\n")
    (tmp_path / "texts" / "B.txt").write_text("Walking")
    assert main([*ft, str(tmp_path / "ft"), "--not-retrieved", str(tmp_path / "nr.txt"), "--after-ta-audit", str(tmp_path / "add.txt")]) == 0
    assert {r["record_id"]: r["decision"] for r in read(tmp_path / "ft" / "decisions.csv")} == {"A": "exclude", "B": "keep"}
    (tmp_path / "r.csv").write_text("record_id,title,abstract\nA,Walking,for some\nB,Chess,for all\nC,Dance,\n")
    assert main([*ft, str(tmp_path / "y")]) == 2  # other content


def test_dispersion_command(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("Row_UID,Study_ID,Outcome_Metric,Arm,N,sd\nR1,S1,o,t,40,1.5\nR2,S1,o,c,40,10\nR3,S2,o,t,36,1.7\nR4,S3,o,c,36,\nR5,S4,p,t,9,2\n")
    assert main(["dispersion", str(tmp_path / "rows.csv"), "--output", str(tmp_path / "f.csv")]) == 0
    assert [(r["Row_UID"], r["rule"]) for r in read(tmp_path / "f.csv")] == [("R1", "A"), ("R3", "B")]
    assert main(["dispersion", str(tmp_path / "rows.csv"), "--output", str(tmp_path / "g.csv"), "--ratio", "1"]) == 2
    assert main(["dispersion", str(tmp_path / "rows.csv"), "--output", str(tmp_path / "h.csv"), "--sd-column", "no"]) == 2


def test_freeze_release_and_codebook(tmp_path, capsys):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_text("x")
    freeze = ["--root", str(tmp_path), "--manifest", "M.json"]
    assert main(["freeze", "create", *freeze, "--scope", "a"]) == 0 and main(["freeze", "verify", *freeze]) == 0
    (tmp_path / "a" / "y.txt").write_text("y")
    assert main(["freeze", "verify", *freeze]) == 1
    assert main(["release", "create", "v1", "--project", str(tmp_path)]) == 0 and main(["release", "activate", "v1", "--project", str(tmp_path)]) == 0
    assert main(["release", "verify", "--project", str(tmp_path)]) == 0 and main(["release", "create", "v1", "--project", str(tmp_path)]) == 2
    (tmp_path / "cb.json").write_text("{}")
    assert main(["codebook", str(tmp_path / "cb.json")]) == 1 and main(["codebook", str(tmp_path / "none.json")]) == 1


def test_the_connector(spark, inputs):
    connector.register(spark)
    out = spark.read.format("bibliography").load(str(inputs / "in")).collect()
    assert len(out) == 8 and {r["source"] for r in out} == {"pubmed", "wos"}
    assert next(r for r in out if r["record_id"] == "PM502")["doi"] == "10.5555/m1"


def test_sql_functions(spark):
    sqlfunctions.register(spark)
    r = spark.sql("SELECT hedges_g(65, 10, 40, 60, 10, 40) AS g, hedges_se(hedges_g(65, 10, 40, 60, 10, 40), 40, 40) AS se, log_odds_ratio(0, 10, 5, 10) AS l, norm_doi(' https://doi.org/10.1/A') AS d, norm_text('Ärger!') AS t, surname('Fox, B') AS s, screening_text(' A  b’s ') AS x").first()
    assert math.isclose(r.g, 0.49517684887459806, rel_tol=1e-12) and math.isclose(r.se, 0.22709424384508942, rel_tol=1e-12)
    assert math.isclose(r.l, math.log(0.5 * 5.5 / (10.5 * 5.5)), rel_tol=1e-12) and (r.d, r.t, r.s, r.x) == ("10.1/a", "arger", "Fox", "a b's")


def test_file_checks(spark):
    df = spark.createDataFrame([("README.md", "[a](docs/x.md) [b](docs/none.md#k) [c](https://e.org) ```[d](no.md)```"), ("docs/x.md", "[up](../README.md) [gone](../gone.md)"), ("k.txt", "-----BEGIN PRIVATE KEY-----"), ("private/n.txt", "x"), ("p.exe", "x")], "path string, text string")
    assert {(r.path, r.target) for r in files_check.broken_links(df).collect()} == {("README.md", "docs/none.md"), ("docs/x.md", "../gone.md")}
    assert [tuple(r) for r in files_check.credentials(df).collect()] == [("k.txt", "private key")]
    assert {r.path for r in files_check.not_public(df, ["private"], [".md", ".txt"]).collect()} == {"private/n.txt", "p.exe"}
    assert files_check.render("{{A}}-{{B}}", {"A": "x"}, {"B": "y\r\n"}) == "x-y\r\n"
    for bad in ({}, {"A": "x", "B": "z"}):
        with pytest.raises(ValueError):
            files_check.render("{{A}}{{B}}", bad, {"B": "y"})
