import json

import pytest

from evspark.llm import responses

ASK = "Decide whether the report below meets criterion C6. Give the decision and a short reason in English."
REQUEST = json.dumps({"instructions": ASK, "mode": "audit", "sources": [{"source_id": "S1", "text": "# Report\nPopulation: adults\nEl informe cumple el criterio porque describe la práctica."}]})
GOOD = "C6 holds; the training is described in line 9. The groups were compared because the arms were of equal size."


@pytest.mark.parametrize("raw,defect", [
    (GOOD, None), (json.dumps({"decision": "include", "rationale": GOOD}), None), (GOOD + "\n- C6\n- line 3", None), ("> El informe cumple el criterio porque describe la práctica.\n\n" + GOOD, None),
    ("The authors refuse to report the mean, hence the row is unresolved.", None), ("I was unable to find an SD, so the field stays null.", None), ("The study cannot be included because adults are not the target.", None),
    (None, "empty"), ("", "empty"), (" \n​", "empty"), ("null", "empty"), ("```json\n```", "empty"), ("<answer></answer>", "empty"), ('{"decision": "", "rationale": null}', "empty"), ("N/A", "empty"), ("...", "empty"),
    (ASK, "copy"), ("Q: " + ASK.upper(), "copy"), (REQUEST, "copy"), (json.dumps({"decision": "x", "rationale": ASK}), "copy"),
    (ASK + "\n# Report\nPopulation: adults\nEl informe cumple el criterio porque describe la práctica.", "copy"), (ASK + "\n# Report\nPopulation: ad", "copy"), ("Population: adults", "truncated"),
    ("I'm sorry, but this table is unclear to me after reading every one of its very many rows and columns and all of the notes below it twice over, so I can't help.", "refusal"),
    ("I can't give the total. " + GOOD + " The rest is in the table.", None),
    ("I'm sorry, but I can't help with assessing this report.", "refusal"), ('{"decision": null, "rationale": "As an assistant, I have to pass on this request."}', "refusal"), ("Leider kann ich bei dieser Anfrage nicht helfen.", "refusal"),
    (GOOD[:-20], "truncated"), ('{"decision": "include", "rationale": "The gro', "truncated"), ("```json\n{\"decision\": \"incl", "truncated"),
    ("El informe cumple el criterio porque describe los diarios de metas con precisión. La puntuación media aumentó en el grupo.", "language"),
    (json.dumps({"decision": "include", "rationale": "В исследовании проверено, как парное чтение влияет на память."}, ensure_ascii=False), "language"),
])
def test_defects(raw, defect):
    assert responses.defect_of(raw, REQUEST, False) == defect


def test_answers_of_a_table(spark, rows):
    cut = [(f"r{i:02d}", 1, "response", (GOOD + " More words follow here and there.")[:60]) for i in range(12)]
    data = [("a", 1, "Response ", ""), ("a", 1, "Response ", ""), ("a", 2, "technical_error", ""), ("b", 1, "RESPONSE", GOOD), ("c", 1, "response", None), ("zz", 3, "response", GOOD), ("d", None, "response", "x" * 300_000 + "."), (None, 1, None, None), *cut]
    df = spark.createDataFrame([(*x, "clash") for x in data], "request_id string, attempt int, kind string, raw_text string, defect string")
    req = spark.createDataFrame([(i, REQUEST) for i in ["a", "b", "c", "d", *[c[0] for c in cut]]] + [("b", REQUEST)], "request_id string, request string")
    out = {(r["request_id"], r["attempt"]): r["defect"] for r in rows(responses.defects(df, req))}
    assert out == {("a", 1): "empty", ("c", 1): "empty"} | {(c[0], 1): "truncated" for c in cut}
    assert [r["size"] for r in rows(responses.length_limits(df.where("raw_text IS NOT NULL")))] == [60]
    assert rows(responses.defects(df.limit(0), req.limit(0))) == []


def test_neighbours_find_all_prefixes(spark, rows):
    texts = ["a", "ab", "abc", "abd", "b", "bcd", "bce", "", "abc"] + [f"t{i:03d}" for i in range(200)] + [f"t{i:03d} and more" for i in range(0, 200, 3)]
    df = spark.createDataFrame([(t,) for t in set(texts)], "raw_text string")
    got = {r["raw_text"] for r in rows(responses.shortened_versions(df))}
    assert got == {t for t in texts if any(u != t and u.startswith(t) for u in texts)}


def test_a_cut_at_a_sentence_end_beside_its_full_version(spark, rows):
    cut = GOOD[: GOOD.index(". ") + 1]
    data = [("a", 1, cut), ("a", 2, GOOD), ("b", 1, cut), ("c", 1, GOOD), ("c", 2, GOOD), (None, 1, cut), (None, 2, GOOD)]
    data += [(f"e{i:02d}", 1, "<answer></answer>") for i in range(20)]
    df = spark.createDataFrame([(i, k, "response", t) for i, k, t in data], "request_id string, attempt int, kind string, raw_text string")
    req = spark.createDataFrame([(i, REQUEST) for i in "abc"], "request_id string, request string")
    out = {(r["request_id"], r["attempt"]): r["defect"] for r in rows(responses.defects(df, req)) if r["defect"] != "empty"}
    assert out == {("a", 1): "truncated"} and rows(responses.length_limits(df)) == []


def test_a_sentence_that_breaks_off_at_a_dot(spark, rows):
    """Rows that only the comparison of neighbours finds: they end as a sentence ends."""
    whole = [f"C{i} holds. The treatment arm (N = {20 + i}) had a mean of {i}.5 with a deviation of {i}.2." for i in range(4)]
    cut = ["C7 holds. The treatment arm (N = 31) had a mean of 41.", "C8 holds. The treatment arm (N = 9)"]
    sound = ["C9 holds. The record was seen on page 7.", "The record was seen on page 5. C9 holds.", json.dumps({"rationale": "The treatment arm (N = 3)"})]
    data = [(f"r{i}", 1, "response", t) for i, t in enumerate(whole + cut + sound)]
    df = spark.createDataFrame(data, "request_id string, attempt int, kind string, raw_text string")
    req = spark.createDataFrame([], "request_id string, request string")
    assert all(responses.defect_of(t, None, False) is None for t in cut)
    assert {r["request_id"]: r["defect"] for r in rows(responses.defects(df, req))} == {"r4": "truncated"}  # r5's end is whole in an object
    rest = df.where("raw_text NOT LIKE '{%'")
    assert {r["request_id"]: r["defect"] for r in rows(responses.defects(rest, req))} == {"r4": "truncated", "r5": "truncated"}
