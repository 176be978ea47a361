import pytest

from evspark.llm import encoding

CLEAN = ["La pratique espacée améliore la mémoire", "Größere Stichproben wären nötig", "a naïve café in Köverö", "исследование с участием людей", "self – reported", "“More is better”", "scores ≥ 12 at 5 °C", "NÃO É SÓ ATENÇÃO", "São Breno"]


def garble(text, right, wrong):
    return "".join(bytes([b]).decode(wrong, "replace") if bytes([b]).decode(wrong, "replace") != "�" else chr(b) for b in text.encode(right))


@pytest.mark.parametrize("right,wrong", [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1251"), ("utf-8", "mac_roman"), ("utf-8", "cp850"), ("cp1252", "mac_roman"), ("cp1252", "cp1251")])
def test_garbled_values_come_back(spark, rows, right, wrong):
    text = CLEAN[0] if right == "cp1252" else CLEAN[0] + " – " + CLEAN[1]
    data = [(f"c{i}_{k}", c, None, "x") for i, c in enumerate(CLEAN) for k in range(6)] + [("bad", garble(text, right, wrong), "", "x"), ("twice", "plain", garble(garble(CLEAN[0], "utf-8", "cp1252"), "utf-8", "cp1252"), "x")]
    out = {(r["record_id"], r["field"]): r for r in rows(encoding.restore(spark.createDataFrame(data, "record_id string, title string, abstract string, word string")))}
    assert set(out) == {("bad", "title"), ("twice", "abstract")}
    assert out["bad", "title"]["restored"] == text and out["bad", "title"]["lossless"]
    assert out["twice", "abstract"]["restored"] == CLEAN[0]


def test_lost_letters_are_guessed_from_the_corpus(spark, rows):
    data = [(f"c{k}", "Größere Stichproben 2013–2022 wären nötig", None) for k in range(5)] + [("bad", "Gr��ere Stichproben 2014�2021 w�ren x�q", ""), ("n", None, None), ("e", "", " ")]
    out = {r["record_id"]: r for r in rows(encoding.restore(spark.createDataFrame(data, "record_id string, title string, abstract string")))}
    assert set(out) == {"bad"} and out["bad"]["restored"] == "Größere Stichproben 2014–2021 wären x�q" and not out["bad"]["lossless"]


def test_sound_text_is_left_alone_and_nothing_breaks(spark, rows):
    odd = CLEAN + ["BELFONTAINE-SUR-ÂGE", "β-weighted", "naïve", "ﬁne ½", "日本語 text", "\U0001f600", "퟿\x07", "é" * 50_000, " no break"]
    df = spark.createDataFrame([(str(i), t, t) for i, t in enumerate(odd)], "record_id string, title string, abstract string")
    assert rows(encoding.restore(df)) == []
    assert rows(encoding.restore(df.limit(0))) == []


def test_a_lattice_reads_part_of_a_word():
    letters = encoding.Letters({"é": 500, "’": 300, "Ã": 2, "©": 1})
    assert encoding.viterbi("l’anxiÃ©tÃ©", "cp1252", letters) == ("l’anxiété", True)
    assert encoding.viterbi("été", "cp1252", letters)[0] == "été"


def test_a_path_to_a_word_of_the_corpus():
    cost = encoding.channel_cost
    assert cost("Gr\ufffd\ufffdere", "Größere") == (2.0, True) and cost("Gr\ufffd\ufffdere", "Gröere") == (1.5, True)
    assert cost("tÃ©moin", "témoin") == (0.0, False) and cost("tÃmoin", "témoin") == (encoding.CUT_COST, True)
    assert cost("w\ufffdren", "waren") is None and cost("x\ufffdq", "xéqu") is None and cost("été", "été") == (1.0, False)
    assert cost("x" * 50_000 + "\ufffd", "x" * 50_000 + "é") == (1.0, True)
    assert encoding.like("AVALIA\ufffdO", "avaliação") == "AVALIAÇÃO" and encoding.like("Gr\ufffdn", "grün") == "Grün"


def test_what_word_frequencies_add(spark, rows):
    """Lost bytes: letters alone would say é for each; the words of the corpus say which letter was lost."""
    data = [(f"c{k}", "A atenção e a avaliação em Köverö", None) for k in range(6)] + [
        ("a", "A atenÃ\u0083o", ""), ("b", "AVALIA\ufffd\ufffdO em K\ufffdver\ufffd", ""), ("c", "a\ufffdaten\ufffd\ufffdo", ""), ("d", "A KÃ¶verÃ", ""), ("e", "A\ufffdem", ""),
    ]
    out = {r["record_id"]: (r["restored"], r["lossless"]) for r in rows(encoding.restore(spark.createDataFrame(data, "record_id string, title string, abstract string")))}
    assert out["b"] == ("AVALIAÇÃO em Köverö", False) and out["d"] == ("A Köverö", False) and out["e"] == ("A\u00a0em", False)
    assert set(out) == {"a", "b", "c", "d", "e"}
