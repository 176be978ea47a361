import random

import pytest

from evspark.llm import leakage

rng = random.Random(5)
NAMES = [f"{a}{b}{c}" for a in ("Zul", "Ber", "Mon", "Tar", "Gis") for b in ("kan", "pol", "ves", "rin") for c in ("tor", "dal", "mus", "hel")]


def item():
    n = lambda: rng.choice(NAMES) + rng.choice(NAMES).lower()
    return " ".join(f"Near {n()}, a guild of bookbinders of {n()} sorted painted tokens for {n()} under amber lamps; in round {rng.randint(1000, 9999)}, errors dropped from {rng.randint(20, 900)} to {rng.randint(20, 99) / 10}." for _ in range(4))


ITEMS = [(i, item()) for i in range(12)]
STYLE = item()


def lossy(text, every):
    w = text.split()
    return " ".join("changed" if i % every == every - 1 else x for i, x in enumerate(w))


def part(text, a, b):
    w = text.split()
    return " ".join(w[int(a * len(w)) : int(b * len(w))])


def test_what_is_held(spark, rows):
    t = ITEMS[3][1]
    half = part(t, 0.3, 0.8)
    docs = {
        1: "Before. " + t + " After.", 2: t.upper().replace(" ", "\n> "), 3: "x " + half, 4: "<p>" + half.replace(" ", "&nbsp;") + "</p>", 5: lossy(half, 9), 6: part(t, 0, 0.3), 7: STYLE, 8: "A guild of bookbinders under amber lamps.",
        9: part(t, 0.2, 0.45) + " " + "and then something else was said about it " * 5 + part(t, 0.45, 0.7), 10: None, 11: "", 12: " ".join(reversed(t.split())), 13: "word " * 60_000 + half, 14: t[:300] + "-\n" + t[300:] if t[299].isalpha() and t[300].isalpha() else t,
        15: t + " " + ITEMS[5][1], 16: part(t, 0.1, 0.35) + " word" * 30_000 + " " + part(t, 0.35, 0.6), 17: part(t, 0.1, 0.35) + " word" * 9_000 + " " + part(t, 0.35, 0.6),
    }
    df = spark.createDataFrame([(i, d, 1) for i, d in docs.items()] + [(1, docs[1], 1)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, x, "c") for i, x in ITEMS] + [(99, None, ""), (98, "", ""), (97, "...", "")], "item_id long, text string, doc_id string")
    assert {(r["doc_id"], r["item_id"]) for r in rows(leakage.leaks(df, bench))} == {(i, 3) for i in (1, 2, 3, 4, 5, 9, 13, 14, 15, 16, 17)} | {(15, 5)}
    assert rows(leakage.leaks(df.limit(0), bench)) == [] and rows(leakage.leaks(df, bench.limit(0))) == []


def test_shards_find_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(leakage, "SHARD_CHARS", 900)
    df = spark.createDataFrame([(i, "a " + t) for i, t in ITEMS], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in rows(leakage.leaks(df, bench))} == {(i, i) for i, _ in ITEMS}


@pytest.mark.parametrize("seed", range(3))
def test_wand_equals_scoring_everything(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    index = leakage.build([(i, " ".join(r.choices(words, weights=range(1, 61), k=r.randint(5, 40)))) for i in range(70)])
    for _ in range(150):
        terms = index.terms.intersection(r.choices(words, k=r.randint(1, 30)))
        score = {}
        for t in terms:
            for x, w in zip(*index.postings[t][:2], strict=True):
                score[x] = score.get(x, 0) + w
        assert (leakage.retrieve(index, terms) if terms else []) == sorted(x for x, s in score.items() if s >= 1)


def test_the_bound_drops_no_stretch():
    index = leakage.build(ITEMS)
    for _, t in ITEMS:
        w = leakage.words(t)
        for every in (3, 4, 6):
            text = leakage.words(lossy(part(t, 0.1, 0.75), every))
            where = {}
            for q, x in enumerate(text):
                where.setdefault(x, []).append(q)
            if leakage.stretch(w, where, index.idf) >= leakage.SHARE:
                assert leakage.may_hold(w, index.terms.intersection(text), index.idf, leakage.SHARE)


def test_many_places_are_the_same(monkeypatch):
    r = random.Random(2)
    index = leakage.build(ITEMS)
    for _, t in ITEMS[:4]:
        text = leakage.words(" ".join(r.choice([x, x, r.choice(t.split())]) for x in (t + " " + t).split()))
        where = {}
        for q, x in enumerate(text):
            where.setdefault(x, []).append(q)
        parts = []
        for many in (1, 10**9):
            monkeypatch.setattr(leakage, "MANY", many)
            parts.append(leakage.stretch(leakage.words(t), where, index.idf))
        assert parts[0] == parts[1] > 0.2
