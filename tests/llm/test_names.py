import itertools

import pytest

from evspark.llm import names


@pytest.mark.parametrize("a,b,same", [
    ("Fisher, Thomas A.", "Thomas A. Fisher", True), ("Fisher, Thomas", "FISHER, thomas", True), ("Fisher, Thomas", "Fisher TA", True), ("Fisher, Thomas A.", "Fisher, T. A.", True),
    ("Fisherman, Thomas", "Fishreman, Tom", True), ("Fisher, Thomas", "Fisher, Margaret", False), ("Fisher, Thomas", "M. Fisher", False), ("Fisher, Thomas A.", "Fisher, T. B.", False),
    ("Königsberger, Nicholas", "Konigsberger N", True), ("ALPHABET Study Group", "The Alphabet-Study-Group", True), ("ALPHABET Study Group", "Alphabet, Thomas", False),
    ("Fisher;Thomas", "Fisher , Thomas", True), ("Fisher, Thomas", "Fischbach, Thomas", False),
])
def test_people(a, b, same):
    x, y = ((*names.parse_person(n), 1, 1) for n in (a, b))
    assert (names.similarity(x, y) >= names.ALIKE) is same


@pytest.mark.parametrize("a,b,same", [
    ("Annals of Clinical Reading and Literacy", "Ann. Clin. Reading Lit.", True), ("Annals of Clinical Reading and Literacy", "Clinical Reading and Literacy, Annals of", True),
    ("Annals of Clinical Reading and Literacy", "Annlas of Clinical Reading and Literacy", True), ("Annals of Clinical Reading and Literacy", "Annals of Social Reading and Literacy", False),
    ("Modern Design Quarterly", "Mod Des Q", True), ("Modern Design Quarterly", "Modern Design Review", False), ("Modern Design", "Modern Design Quarterly", False),
])
def test_journals(a, b, same):
    x, y = ((*names.parse_journal(n), 1, 1) for n in (a, b))
    assert (names.similarity(x, y) >= names.ALIKE) is same


def test_the_collision_curve():
    n = names.bands()
    assert 1 - (1 - names.MEET_AT**names.ROWS) ** n >= names.MEET > 1 - (1 - names.MEET_AT**names.ROWS) ** (n - 1)
    seeds = names._seeds(4000)
    a, b = names.grams("person", "gorelfilkin"), names.grams("person", "gorelfilikn")
    agree = (names.signature(a, seeds) == names.signature(b, seeds)).mean()
    assert abs(agree - len(a & b) / len(a | b)) < 0.05


GROUPS = [
    ["Balzilkalbor, Alexander E.", "Alex Balzilkalbor", "A. Balzilkalbor", "Balzilkalbor AE", "Balzilkabor, Alexander"], ["Balzilkalbor, Gabriel", "balzilkalbor, gabriel", "Gabe Balzilkalbor"],
    ["Tirmonvasgel, Gabriel"], ["ZANTULBOR Study Group", "Study Group ZANTULBOR", "ZANTULBOR study grp."],
]


def test_pairs_equal_the_planted_ones(spark, rows):
    data = [(n, None, 7) for g in GROUPS for n in g for _ in range(3 if n == g[0] else 1)] + [("Anonymous", " ", 1), ("anonymous", "", 1), (None, None, None), ("", "Journal of Tests", 1), ("", "J. Tests", 1), ("¿?", "x" * 5000, 1)]
    out = rows(names.same_entity(spark.createDataFrame(data, "first_author string, journal string, n int")))
    found = {(r["name_a"], r["name_b"]) for r in out if r["field"] == "first_author"}
    assert found == {tuple(sorted(p)) for g in GROUPS for p in itertools.combinations(g, 2)}
    assert [(r["name_a"], r["name_b"]) for r in out if r["field"] == "journal"] == [("J. Tests", "Journal of Tests")]
    assert rows(names.same_entity(spark.createDataFrame([], "first_author string, journal string"))) == []


def test_stars_do_not_chain(spark, rows):
    forms = spark.createDataFrame([("a", 1, 9), ("b", 1, 5), ("c", 1, 3), ("d", 1, 1), ("e", 1, 1)], "form string, full int, n long")
    links = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.9), ("c", "d", 0.9)], "u string, v string, s double")
    assert {r["form"]: r["centre"] for r in rows(names.stars(forms, links))} == {"a": "a", "b": "a", "c": "c", "d": "c", "e": "e"}


@pytest.mark.parametrize("kind", ["person", "journal"])
def test_all_names_at_one_edit_meet(kind):
    """Held against brute force on short names, where one edit leaves few trigrams in common."""
    import random

    import pandas as pd

    rng, letters = random.Random(3), "abcdefghijklmnopqrstuvwxyz"
    spelled = ["smith", "smiht", "johnson", "jonhson", "brain", "brian"]
    for size in [4, 5, 6, 7] * 12:
        w = "".join(rng.choice(letters) for _ in range(size))
        i = rng.randrange(size - 1)
        spelled += [w, w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + rng.choice(letters) + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:]]
    spelled = sorted(set(spelled))
    want = {(a, b) for a, b in itertools.combinations(spelled, 2) if names.near(a, b) == 1}
    keys = {w: names.key_of(kind, w) for w in spelled}
    ids = {key: i for i, key in enumerate(sorted(set(keys.values())))}
    pdf = pd.DataFrame([(i, kind, key) for key, i in ids.items()], columns=["id", "kind", "key"])
    dealt = pd.concat(names._band_rows([pdf])).sort_values("hash")
    met = {(min(p), max(p)) for part in names._meetings([dealt]) for p in zip(part["id"], part["id2"], strict=True)}
    lost = {(a, b) for a, b in want if keys[a] != keys[b] and tuple(sorted((ids[keys[a]], ids[keys[b]]))) not in met}
    assert len(want) > 200 and not lost


@pytest.mark.parametrize("core", [0, 30, names.CORE])
def test_stars_equal_one_form_at_a_time(spark, rows, core):
    """Also along a chain of falling weights, and whatever one task may finish."""
    import random

    rng = random.Random(core)
    forms = [(f"f{i:02d}", rng.randint(0, 1), rng.randint(1, 5)) for i in range(40)] + [(f"z{i:02d}", 1, 100 - i) for i in range(25)]
    links = {tuple(sorted(rng.sample([f[0] for f in forms[:40]], 2))): rng.choice([0.86, 0.9, 0.95]) for _ in range(60)}
    links |= {(f"z{i:02d}", f"z{i + 1:02d}"): 0.9 for i in range(24)}
    near = {f[0]: {} for f in forms}
    for (a, b), s in links.items():
        near[a][b] = near[b][a] = s
    order = {f[0]: (f[1], f[2], len(near[f[0]]), f[0]) for f in forms}
    centres = []
    for f in sorted(order, key=order.get, reverse=True):
        if not near[f].keys() & set(centres):
            centres.append(f)
    want = {f: f if f in centres else max(near[f].keys() & set(centres), key=lambda c, f=f: (near[f][c], order[c])) for f in order}
    df = names.stars(spark.createDataFrame(forms, "form string, full int, n long"), spark.createDataFrame([(*p, s) for p, s in links.items()], "u string, v string, s double"), core)
    assert {r["form"]: r["centre"] for r in rows(df)} == want


def test_large_bands_are_dealt_to_blocks(spark, rows, monkeypatch):
    keys = spark.createDataFrame([(i, "person", "gorelfilkin" + "abcdefghijklmnopqrstuvwxyz"[i]) for i in range(26)], "id long, kind string, key string")
    every = {(r["id"], r["id2"]) for r in rows(names.meeting(keys))}
    assert every == set(itertools.combinations(range(26), 2))
    import pandas as pd

    monkeypatch.setattr(names, "RUN", 10)
    dealt = pd.DataFrame({"hash": [1] * 3 + [2] * 40 + [3] * 2 + [4] * 25, "id": [*range(3), *range(40), 7, 8, *range(25)]})
    for step in (1, 7, 100):
        out = pd.concat(list(names._meetings(dealt.iloc[b : b + step] for b in range(0, len(dealt), step))))
        alone, pairs = out[out["id2"].isna()], out[out["id2"].notna()]
        assert sorted(zip(pairs["id"], pairs["id2"])) == [(0, 1), (0, 2), (1, 2), (7, 8)]
        assert sorted(zip(alone["hash"], alone["id"])) == [(2, i) for i in range(40)] + [(4, i) for i in range(25)]


def syllables(n, seed=5):
    """Surnames of few syllables, each with one that is an edit or a swap away."""
    import random

    rng = random.Random(seed)
    parts = [a + b + c for a in "bdgklmt" for b in "aio" for c in "lnr"]
    spelled = {"".join(rng.choice(parts) for _ in range(4)) for _ in range(n)}
    for w in sorted(spelled)[: n // 4]:
        i = rng.randrange(len(w) - 1)
        spelled.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "e" + w[i + 1 :], w[:i] + "ß" + w[i:]]))
    return sorted(spelled)


def test_names_of_common_syllables_do_not_meet_by_chance(spark, rows):
    """What chance brings into a band is not written, and the rows of the bands give their disk back."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        return sum(f.length() for f in map(files.apply, range(files.size())) if f.getName().startswith("shuffle_"))

    spelled = syllables(800)
    keys = spark.createDataFrame([(i, "person", w) for i, w in enumerate(spelled)] + [(-1, "group", spelled[0])], "id long, kind string, key string")
    want = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(spelled), 2) if abs(len(a) - len(b)) < 2 and names.near(a, b) == 1}
    before = shuffled()
    met = names.meeting(keys)
    written = shuffled() - before
    found = {tuple(sorted((r["id"], r["id2"]))) for r in rows(met)}
    assert len(want) > 150 and want <= found and len(found) < 2 * len(want)
    assert written < 200_000  # 0.1 million rows of bands


def test_sketches_of_one_edit(spark, rows):
    """Two bits at most, whatever the letters; and the two ways to compare sketches agree."""
    import random

    import numpy as np

    rng, letters = random.Random(7), "aabbcdefgßé9 ж"
    x, y = [], []
    for _ in range(2000):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(2, 15)))
        i, c = rng.randrange(len(w) - 1), rng.choice(letters)
        v = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[::-1][:i] + c * 3])
        kind = rng.choice([("person", "person"), ("group", "group"), ("journal", "journal"), ("person", "journal"), ("group", "person")])
        x.append((kind[0], w))
        y.append((kind[1], v))
    a, b = (np.array([names.sketch(*k) for k in v], dtype=np.uint64).view(np.int64) for v in (x, y))
    may = names._may_agree(a, b)
    for (kind, w), (kind2, v), m in zip(x, y, may, strict=True):
        if kind != kind2 or kind == "journal":
            assert m == (kind == kind2)
        elif names.near(w, v) <= 1:
            assert m
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(zip(a.tolist(), b.tolist(), strict=True))], "i int, a long, b long")
    out = {r["i"]: r["m"] for r in rows(df.select("i", names._may_agree_columns(df["a"], df["b"]).alias("m")))}
    assert [out[i] for i in range(len(may))] == may.tolist() and 0 < sum(may) < len(may)
