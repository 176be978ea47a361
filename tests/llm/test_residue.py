import pytest

from evspark.llm import residue

FILLER = "Lorem ipsum dolor sit amet tempor velit mollit tempor aliqua consectetur labore."


@pytest.mark.parametrize("text,found", [
    ("A mean of {{ mean }} was seen.", True), ("A mean of ${mean_score} was seen.", True), ("of {% N %} was", True), ("[[title]] was", True), ("<<sd>> was", True), ("«date» was", True), ("@@site@@ was", True),
    ("%TITLE% was", True), ("__SITE_NAME__ was", True), ("#DATE# was", True), ("[INSERT DATE HERE] was", True), ("[Enter title] was", True), ("[journal to be added] was", True), ("_______ [sd] was", True),
    ("……… (date) was", True), ("TBD (title) was", True), ("TODO: fill in title", True), ("XX.X (SD XX.X) for x", True), ("a <first_author> was", True), ("a <title> was", True),
    ("The template field {{title}} was replaced by the value.", False), ("Placeholders of the form [INSERT DATE] are described.", False), ("The form used double braces (“%TITLE%”) for fields.", False),
    ("a < b > c in [12] and [Table 3] wrote [sic] <20", False), ("<em>burns</em> and <b>x</b>", False), ("<title>page</title>", False), ("95 % interval, 40 % of all # 3", False), ("«Bonjour tout le monde»", False), ("«site name» and {{ " + "name " * 30 + "}}", True), ("[insert " + "x" * 200 + "]", True),
    ("The set of TODO notes fell. Raters typed TBD or XX.", False),
])
def test_fields(text, found):
    assert residue.has_field(text) is found


LINES = [
    ("Please enable JavaScript to view this article.", True), ("YOUR BROWSER DOES NOT SUPPORT SCRIPTS, SO THE READER CANNOT BE DISPLAYED.", True), ("Bitte  aktivieren Sie JavaScript, um den Volltext anzuzeigen.", True),
    ("404 – page not found. The address you asked for does not exist on this server.", True), ("Error 503: the service is temporarily unavailable. Please try again later.", True), ("HTTP/1.1 403 Forbidden", True), (FILLER, True),
    ("blah foo bar test xxx foo bar blah asdf qwer", True), ("Your text goes here. Replace this paragraph. Sample abstract text. " * 7, True), ("Access denied. You don't have permission to view this page (code 31).", True),
    ("Note: checking your browser before granting access. Scripts must be allowed for this check.", True),
    ("Error pages such as “404 not found” made up 41 per cent of the failed downloads.", False), ("In the study, a “please enable JavaScript” banner was shown to half of the adults.", False),
    ("Stimuli were blocks of lorem ipsum text, so that participants could not rely on meaning.", False), ("Too many requests for make-up tests came from adults, and 3 were denied.", False),
    ("Pupils whose browsers had JavaScript disabled saw a plain version.", False), ("The 404 pupils and 503 parents who answered were not found to differ.", False), ("", False),
]


def test_lines(spark, rows):
    df = spark.createDataFrame([(i, "A title\n" + x + "\nand more") for i, (x, _) in enumerate(LINES)], "doc_id long, text string")
    assert {r["doc_id"] for r in rows(residue.residue(df))} == {i for i, (_, found) in enumerate(LINES) if found}


def test_labelled_lines_are_bounded():
    assert residue.expanded("a {b|c} d{|e}") == ["a b d", "a b de", "a c d", "a c de"]
    assert len(residue._labelled(tuple(residue.LABELLED))[0]) < 2_000


def test_simhash_of_lines():
    import numpy as np

    codes = residue._Codes()
    stream = lambda text: np.array([codes[t] for t in residue._TOKEN.findall(text.lower())], dtype=np.uint64)
    many = "\n".join(f"line number {i} of a text with some words in it" for i in range(300)) + "\nshort\n\n\nlast one here"
    def simhashes(x):
        first, h, at = residue.shingle_hashes(stream(x))
        assert len(first) == len(at)
        return residue.simhashes_of(h, at).tolist()

    sim = simhashes(many)
    assert sim == [simhashes(x)[0] for x in many.split("\n") if x] and len(set(sim[:300])) == 1
    assert simhashes("") == simhashes("\n\n") == []


def test_tables_keep_all_pairs_at_three_bits(spark, rows):
    import random

    rng = random.Random(3)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    sims = []
    for _ in range(200):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), 3):
            y ^= 1 << bit
        sims += [signed(x), signed(y)]
    df = spark.createDataFrame(list(enumerate(sims)), "key long, sim long")
    for n in (len(sims), residue.SMALL + 1):  # broadcast and shuffled
        found = {(r["u"], r["v"]) for r in rows(residue.near_duplicates(df.where("key % 2 = 0"), df, n))}
        assert found == {(i, i + 1) for i in range(0, len(sims), 2)}


BASE = "Please enable JavaScript in the settings of your own web browser before you try to open the full text of this archived article of the repository again later today thank you very much for all of your kind patience with us"


def test_texts(spark, rows):
    variant = "We ask: " + BASE
    unlike = "Pupils were asked to open the full text of an article of the repository later today."
    data = [(1, BASE), (2, "Title\n" + variant), (3, "Title\n" + unlike), (4, None), (5, ""), (6, "A {{mean}} here"), (7, "A 5.2 here"), (8, "\n\n" + FILLER), (9, "x\n" * 5000 + BASE), (10, BASE), (10, "other"), (11, "word " * 100_000)]
    df = spark.createDataFrame([(i, t, "k", 0) for i, t in data], "doc_id long, text string, doc_kind string, label int")
    out = {r["doc_id"]: (r["n_fields"], r["n_lines"]) for r in rows(residue.residue(df, (BASE,)))}
    assert out == {1: (0, 1), 2: (0, 1), 6: (1, 0), 8: (0, 1), 9: (0, 1), 10: (0, 1)}
    assert {r["doc_id"] for r in rows(residue.without_residue(df))} == {1, 2, 3, 4, 5, 7, 9, 10, 11}
    assert rows(residue.residue(df.limit(0))) == []


def test_labels_spread_to_verified_neighbours(spark, rows):
    nodes = spark.createDataFrame([(1, 0b0), (2, 0b11), (3, 0b1111111), (4, 1 << 40)], "key long, sim long")
    near = {(r["u"], r["v"]) for r in rows(residue.near_duplicates(nodes, nodes, 4)) if r["u"] < r["v"]}
    assert near == {(1, 2), (1, 4), (2, 4)}
    a = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    assert len(residue.shingles(a) & residue.shingles(a + " more")) / len(residue.shingles(a) | residue.shingles(a + " more")) > residue.SIMILARITY


def test_equal_words_share_a_label(spark, rows):
    data = [(1, "Sorry. Page not found."), (2, "Sorry, page not found."), (3, "x\nSORRY - page not found!"), (4, "Sorry, the page was not found by 3 of them.")]
    out = {r["doc_id"]: (r["n_fields"], r["n_lines"]) for r in rows(residue.residue(spark.createDataFrame(data, "doc_id long, text string")))}
    assert out == {1: (0, 1), 2: (0, 1), 3: (0, 1)}


@pytest.mark.parametrize("small", [residue.SMALL, 0])
def test_the_label_reaches_all_lines_of_the_similarity(spark, rows, small, monkeypatch):
    """Held against brute force: the lines linked to a trusted one by pairs of Jaccard SIMILARITY."""
    import random

    monkeypatch.setattr(residue, "SMALL", small)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    texts, labelled = [], []
    for size in [6, 8, 9, 12, 20, 40, 80] * 4:
        base = [word() for _ in range(size + 3)]
        labelled.append(" ".join(base))
        texts.append(" ".join(base))
        for cut in (1, 2, 4, 8, 16):  # the more, the less alike
            texts.append(" ".join(["We", "ask", *(base if cut == 1 else base[: -cut + 1]), *(word() for _ in range(cut - 1))]))
            texts.append(" ".join([word(), *texts[-1].split()]))  # similar to the variant, maybe not to the line itself
    data = list(enumerate(texts))
    sets = {i: residue.shingles(t) for i, t in data}
    alike = {i: [j for j, q in sets.items() if len(p & q) >= residue.SIMILARITY * len(p | q)] for i, p in sets.items()}
    want = {i for i, t in data if t in labelled}
    trusted, new = len(want), set(want)
    while new:
        new = {j for i in new for j in alike[i]} - want
        want |= new
    got = {r["doc_id"] for r in rows(residue.residue(spark.createDataFrame(data, "doc_id long, text string"), tuple(labelled)))}
    assert got == want and trusted + 50 < len(want) < len(texts)


def test_what_the_graph_adds(spark, rows):
    """Without links only the labelled lines themselves are found."""
    line = "Your text goes here. Replace this paragraph. Sample abstract text. "
    df = spark.createDataFrame([(1, line), (2, line * 2), (3, "Note: " + line * 9), (4, "The text goes to press. Replace this paragraph.")], "doc_id long, text string")
    assert {r["doc_id"] for r in rows(residue.residue(df))} == {1, 2, 3}
    alone = {k for _, k, _, _, _ in residue._labelled(tuple(residue.LABELLED))[0]}
    assert {r["doc_id"] for r in rows(residue.lines(df)) if r["key"] in alone} == {1, 2}
