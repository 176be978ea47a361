"""Variant spellings of names typed by people (problem 2).

Method: every distinct spelling is parsed into a form (surname, given name and initials of a person, the name of a
group, the words of a periodical). MinHash signatures over the padded q-grams of the forms' keys are cut into bands;
the number of bands is taken from the collision curve, so that forms of similarity MEET_AT meet with the wanted
probability. One typing error leaves less than that of a short name: keys also meet if a letter taken from each makes
them equal, which all keys at one edit or swap do. Pairs that meet are verified by Monge-Elkan similarity of their words, where an initial
or an abbreviation agrees with the word it begins and a nickname with its name, and where every word has to find its
match. Star clustering then takes full and frequent forms as centres, none of them linked to another one, and gives each
other form to the one centre it fits best, so that chains of errors join nothing.

Names built of the same syllables meet in bands by chance, as often as the square of their number. So a key goes through the
bands with a sketch of its letters, and a pair whose sketches lie more than an edit apart is never written; and the bands are
worked off in STEPS steps, each of which gives its shuffle files back.

Spellings are counted before anything else: however often a name occurs, it is one row from there on.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
import unicodedata

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.operators.components import CORE
from evspark.runtime import checkpoint, pairs_within, table

FIELDS = ("first_author", "journal")
#: q-grams, rows of a band, the similarity at which forms have to meet, and with which probability.
Q, ROWS, MEET_AT, MEET = 3, 4, 0.45, 0.985
#: Keys that meet in one band up to which one task pairs them; those of larger bands are dealt to blocks.
RUN = 1_000
#: Steps in which the bands are worked off: one step's rows of the bands are on disk at a time.
STEPS = 4
#: Least Monge-Elkan similarity of two forms, and of a word with its match.
ALIKE, WORD_ALIKE = 0.86, 0.74

#: Fixed: nicknames of the given names in use.
NICKNAMES = {
    "alex": "alexander", "sasha": "alexander", "izzy": "isabella", "sanna": "susanna", "bella": "isabella", "isa": "isabella", "beth": "elizabeth", "liz": "elizabeth", "lizzie": "elizabeth", "eliza": "elizabeth",
    "betty": "elizabeth", "bill": "william", "will": "william", "billy": "william", "bob": "robert", "rob": "robert", "bobby": "robert", "charlie": "charlotte",
    "lottie": "charlotte", "dot": "dorothea", "dora": "dorothea", "thea": "dorothea", "dolly": "dorothea", "fred": "frederick", "freddie": "frederick",
    "gabe": "gabriel", "helen": "helena", "lena": "helena", "nell": "helena", "jo": "josephine", "josie": "josephine", "kate": "katherine", "kathy": "katherine",
    "katie": "katherine", "kat": "katherine", "kay": "katherine", "leo": "leonora", "nora": "leonora", "maggie": "margaret", "meg": "margaret", "peggy": "margaret",
    "mike": "michael", "mick": "michael", "micky": "michael", "nick": "nicholas", "nicky": "nicholas", "ollie": "oliver", "olly": "oliver", "noll": "oliver",
    "pat": "patricia", "patty": "patricia", "trish": "patricia", "tricia": "patricia", "sue": "susanna", "susie": "susanna", "suzy": "susanna", "anna": "susanna",
    "ted": "theodore", "teddy": "theodore", "theo": "theodore", "tom": "thomas", "tommy": "thomas", "vince": "vincent", "vinny": "vincent", "vic": "victor",
    "lanny": "yolanda", "yoli": "yolanda", "yola": "yolanda", "zach": "zachary", "zack": "zachary", "zac": "zachary", "zak": "zachary", "dan": "daniel", "dave": "david",
    "ed": "edward", "jim": "james", "joe": "joseph", "sam": "samuel", "steve": "stephen", "tony": "anthony", "andy": "andrew", "ben": "benjamin", "chris": "christopher",
    "matt": "matthew", "greg": "gregory", "jenny": "jennifer", "becky": "rebecca", "vicky": "victoria", "abby": "abigail", "mandy": "amanda", "cathy": "catherine",
}
#: Fixed: words of group names and words of periodicals that carry no name.
GROUP_WORDS = frozenset("group grp study consortium collaboration collaborative collaborators network team investigators committee the for of on behalf and".split())
GROUP_SIGNS = frozenset("group grp consortium collaboration collaborative collaborators network team investigators committee".split())
SMALL_WORDS = frozenset("of and the for in on a an & der die das und de la le et y".split())
NOBODY = frozenset("anonymous anon anonym na none unknown null nil noauthor noauthorlisted notavailable".split())

_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Small letters without accents."""
    text = text.replace("ß", "ss").replace("ø", "o").replace("Ø", "O").replace("ł", "l").replace("Ł", "L").replace("æ", "ae").replace("œ", "oe")
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def parse_person(name: str) -> tuple[str, str, str, str] | None:
    """(kind, surname or group, given name or initial, further initials) in folded letters; None if it names nobody."""
    text = unicodedata.normalize("NFC", name).strip()
    words = _WORD.findall(fold(text))
    if not words or "".join(words) in NOBODY:
        return None
    if GROUP_SIGNS & set(words):
        rest = [w for w in words if w not in GROUP_WORDS]
        return ("group", " ".join(sorted(rest or words)), "", "")
    if re.search("[,;]", text):
        head, tail = re.split("[,;]", text, maxsplit=1)
        surname, given = _WORD.findall(fold(head)), _WORD.findall(tail)
        if not surname:
            surname, given = [fold(w) for w in given[-1:]], given[:-1]
    else:
        raw = _WORD.findall(text)
        if len(raw) == 1:
            surname, given = [fold(raw[0])], []
        elif (raw[-1].isupper() and len(raw[-1]) <= 3 and len(raw[0]) > 1) or len(raw[-1]) == 1:
            k = next(i for i in range(1, len(raw)) if all(len(w) == 1 or (w.isupper() and len(w) <= 3) for w in raw[i:]))
            surname, given = [fold(w) for w in raw[:k]], raw[k:]
        else:
            k = next((i for i in range(len(raw) - 1, 0, -1) if len(raw[i - 1]) == 1), 1)
            surname, given = [fold(w) for w in raw[k:]], raw[:k]
    if given and given[0].isupper() and 1 < len(given[0]) <= 3 and (len(given) == 1 or all(len(g) == 1 for g in given[1:])):
        given = [*given[0], *given[1:]]  # joined initials
    given = [fold(g) for g in given]
    first = NICKNAMES.get(given[0], given[0]) if given else ""
    return ("person", " ".join(surname), first, "".join(g[0] for g in given[1:]))


def parse_journal(name: str) -> tuple[str, str, str, str] | None:
    words = _WORD.findall(fold(name))
    if not words or "".join(words) in NOBODY:
        return None
    rest = sorted(w for w in words if w not in SMALL_WORDS)
    return ("journal", " ".join(rest or sorted(words)), "", "")


def key_of(kind: str, name: str) -> str:
    """What the q-grams are taken from: the name of a person or group, the beginnings of a periodical's words."""
    return " ".join(w[:4] for w in name.split()) if kind == "journal" else name


# ---- MinHash


def bands(rows: int = ROWS, at: float = MEET_AT, wanted: float = MEET) -> int:
    """The least number of bands of so many rows for which the collision curve 1 - (1 - s^rows)^bands reaches
    ``wanted`` at similarity ``at``."""
    return math.ceil(math.log(1 - wanted) / math.log(1 - at**rows))


def grams(kind: str, key: str) -> set[str]:
    if kind == "journal":
        padded = ["^" * (Q - 1) + w for w in key.split()]  # without an end, which an abbreviation lacks
    else:
        padded = ["^" * (Q - 1) + key + "$" * (Q - 1)]
    return {w[i : i + Q] for w in padded for i in range(max(1, len(w) - Q + 1))}


def shortened(kind: str, key: str) -> set[str]:
    """The key, and the key without each of its letters: two keys at one edit or swap have one of these in common.

    The words of a periodical are put in order again, since an edit may have moved one.
    """
    words = key.split(" ") if kind == "journal" else [key]
    return {key} | {" ".join(sorted([*words[:k], w[:i] + w[i + 1 :], *words[k + 1 :]])) for k, w in enumerate(words) for i in range(len(w))}


def _seeds(n: int) -> np.ndarray:
    return np.random.default_rng(20240101).integers(0, 1 << 63, n, dtype=np.uint64)


def signature(items: set[str], seeds: np.ndarray) -> np.ndarray:
    """The least mixed hash of the items under each seed."""
    z = np.array([xxhash.xxh64_intdigest(x) for x in items], dtype=np.uint64)[:, None] ^ seeds[None, :]
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(29)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(32)
    return z.min(axis=0)


def sketch(kind: str, key: str) -> int:
    """64 bits: the kind in the upper two, and of each letter's first, second and further occurrences one bit each, where
    bits that meet cancel out. A letter more or less turns one bit, so keys at one edit or swap differ in two at most.
    """
    bits, seen = 0, {}
    for c in key:
        n = seen[c] = seen.get(c, 0) + 1
        bits ^= 1 << (2 * (ord(c) - 97) + n - 1 if "a" <= c <= "z" and n < 3 else 52 + (ord(c) + n) % 10)
    return bits | ("person", "group", "journal").index(kind) << 62


def _may_agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the keys of two sketches have one kind and, unless they are periodicals, may be at one edit or swap."""
    off = a ^ b
    return (off >> 62 == 0) & ((a < 0) | (np.bitwise_count(off) <= 2))


def _may_agree_columns(a: Column, b: Column) -> Column:
    off = a.bitwiseXOR(b)
    return (F.shiftright(off, 62) == 0) & ((a < 0) | (F.bit_count(off) <= 2))


def _band_rows(batches, first: int = 0, last: int | None = None):
    """(id, hash, sketch) of the bands from first to before last, and with the first band of the keys without a letter."""
    n = bands()
    last = n if last is None else last
    seeds = _seeds(n * ROWS)[first * ROWS : last * ROWS]
    weights = _seeds(n * ROWS + ROWS)[-ROWS:] | np.uint64(1)
    for pdf in batches:
        for begin in range(0, len(pdf), 500):
            part = pdf.iloc[begin : begin + 500]
            sketches = np.array([sketch(*x) for x in zip(part["kind"], part["key"], strict=True)], dtype=np.uint64).view(np.int64)
            sigs = np.stack([signature(grams(kind, key), seeds) for kind, key in zip(part["kind"], part["key"], strict=True)])
            mixed = (sigs.reshape(len(part), last - first, ROWS) * weights).sum(axis=2, dtype=np.uint64)
            mixed ^= np.arange(first, last, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # the band
            yield pd.DataFrame({"id": np.repeat(part["id"].to_numpy(), last - first), "hash": mixed.ravel().view(np.int64), "sketch": np.repeat(sketches, last - first)})
            if first == 0:
                exact = [
                    (i, xxhash.xxh64_intdigest(f"{kind}|{x}"), s)
                    for i, kind, key, s in zip(part["id"], part["kind"], part["key"], sketches, strict=True) for x in shortened(kind, key)
                ]
                ids, hashes, of = zip(*exact, strict=True)
                yield pd.DataFrame({"id": np.array(ids, dtype=np.int64), "hash": np.array(hashes, dtype=np.uint64).view(np.int64), "sketch": np.array(of, dtype=np.int64)})


def _meetings(batches):
    """Pairs of ids with one hash that may agree, from rows sorted by hash: one pass over the bands, RUN ids of a band in
    memory at most. Of a larger band the ids alone, with the hash and without a partner. Without sketches any pair may agree.
    """
    rest = np.empty((0, 3), dtype=np.int64)
    large: int | None = None  # the hash of the large band that goes on

    def alone(rows):
        return pd.DataFrame({"hash": rows[:, 0], "id": rows[:, 1], "id2": pd.array([None] * len(rows), dtype="Int64"), "sketch": rows[:, 2]})

    def paired(rows, size):
        """The pairs within bands of these sizes, which lie one behind the other."""
        after = np.repeat(np.cumsum(size), size) - np.arange(len(rows)) - 1  # rows of the band behind each row
        left = np.repeat(np.arange(len(rows)), after)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
        some = _may_agree(rows[left, 2], rows[right, 2]) & (rows[left, 1] != rows[right, 1])
        a, b = rows[left[some], 1], rows[right[some], 1]
        return pd.DataFrame({"hash": np.zeros(len(a), dtype=np.int64), "id": np.minimum(a, b), "id2": pd.array(np.maximum(a, b), dtype="Int64"), "sketch": np.zeros(len(a), dtype=np.int64)})

    for pdf in itertools.chain(batches, [None]):
        if pdf is not None:
            rest = np.concatenate((rest, pdf.reindex(columns=["hash", "id", "sketch"], fill_value=0).to_numpy(dtype=np.int64)))
        if large is not None:
            go_on = int(np.searchsorted(rest[:, 0], large, "right"))
            if go_on:
                yield alone(rest[:go_on])
                rest = rest[go_on:]
            if len(rest):
                large = None
        if not len(rest):
            continue
        whole = int(np.searchsorted(rest[:, 0], rest[-1, 0])) if pdf is not None else len(rest)  # the last band may go on
        if len(rest) - whole > RUN:
            large = int(rest[-1, 0])
            yield alone(rest[whole:])
            rest = rest[:whole]
        done, rest = rest[:whole], rest[whole:]
        begin = np.flatnonzero(np.concatenate(([True], np.diff(done[:, 0]) != 0))) if whole else np.empty(0, dtype=np.int64)
        size = np.diff(np.concatenate((begin, [whole])))
        for b, n in zip(begin[size > RUN].tolist(), size[size > RUN].tolist(), strict=True):
            yield alone(done[b : b + n])
        several = (size > 1) & (size <= RUN)
        done, size = done[np.repeat(several, size)], size[several]
        pairs, ends = np.cumsum(size * (size - 1) // 2), np.cumsum(size)
        b = 0
        while b < len(size):  # some 100,000 pairs at once, or those of one band
            e = max(b + 1, int(np.searchsorted(pairs, 100_000 + (pairs[b - 1] if b else 0), "right")))
            yield paired(done[ends[b] - size[b] : ends[e - 1]], size[b:e])
            b = e


def meeting(keys: DataFrame, run: int = RUN) -> DataFrame:
    """(id, id2): pairs of keys (id, kind, key) that meet in a band or without a letter, less those of persons and groups that
    no one edit or swap can make equal and those of two kinds."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a fixed number of partitions: the bytes of a key say nothing of what its signature costs
    dealt = keys.repartition(parts, "id")
    steps = []
    for some in np.array_split(np.arange(bands()), STEPS):
        rows = functools.partial(_band_rows, first=int(some[0]), last=int(some[-1]) + 1)
        banded = dealt.mapInPandas(rows, "id long, hash long, sketch long").repartition(parts, "hash").sortWithinPartitions("hash")
        steps.append(checkpoint(banded.mapInPandas(_meetings, "hash long, id long, id2 long, sketch long").distinct(), tidy=True))
    met = functools.reduce(DataFrame.unionByName, steps)
    large = pairs_within(met.where("id2 IS NULL").select("hash", F.struct("id", "sketch").alias("key")), ["hash"], "key", run)
    large = large.where(_may_agree_columns(F.col("key_a.sketch"), F.col("key_b.sketch")))
    return met.where("id2 IS NOT NULL").select("id", "id2").unionByName(large.select(F.col("key_a.id").alias("id"), F.col("key_b.id").alias("id2"))).distinct()


# ---- verification


def near(a: str, b: str) -> int:
    """Edit distance with neighbours swapped as one edit; 3 stands for 3 and more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 2:
        return 3
    two, one, row = None, None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        two, one, row = one, row, [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
    return min(3, row[-1])


def word_similarity(a: str, b: str, short: bool) -> float:
    """1 for equal words, 0.95 for an abbreviation and its word if ``short`` allows any, else by edit distance."""
    if a == b:
        return 1.0
    less, more = sorted((a, b), key=len)
    if short and more.startswith(less) and len(less) < len(more):
        return 0.95
    d, size = near(a, b), max(len(a), len(b))
    return 1 - d / size if d <= (1 if size < 9 else 2) and d < size / 3 else 0.0


def monge_elkan(a: list[str], b: list[str], short: bool) -> float:
    """Symmetric Monge-Elkan similarity with each word matched once; 0 if a word of either finds no match."""
    if len(a) != len(b):
        return 0.0
    pairs = sorted(((word_similarity(x, y, short), i, j) for i, x in enumerate(a) for j, y in enumerate(b)), key=lambda p: (-p[0], p[1], p[2]))
    used_a, used_b, total = set(), set(), 0.0
    for s, i, j in pairs:
        if s < WORD_ALIKE:
            break
        if i not in used_a and j not in used_b:
            used_a.add(i)
            used_b.add(j)
            total += s
    return total / len(a) if len(used_a) == len(a) else 0.0


def similarity(x: tuple, y: tuple) -> float:
    """Of two forms (kind, name, given, initials, n, n_forms); 0 if they can't mean the same."""
    kind, name, given, middle, n, forms = x
    kind2, name2, given2, middle2, n2, forms2 = y
    if kind != kind2:
        return 0.0
    if kind == "journal":
        return monge_elkan(name.split(), name2.split(), True)
    own = monge_elkan(name.split(), name2.split(), False)
    if name != name2:
        # two names that both stand on their own are two names, however alike
        less, more = sorted(((n, forms), (n2, forms2)))
        if near(name, name2) > 1 or (less[1] > 2 and less[0] * 2 > more[0]):
            return 0.0
    if kind == "group":
        return own
    if bool(given) != bool(given2) or (middle and middle2 and middle[0] != middle2[0]):
        return 0.0
    if len(given) == 1 or len(given2) == 1:
        first = 0.95 if given[:1] == given2[:1] else 0.0
    else:
        first = word_similarity(given, given2, False)
    return (own + first) / 2 if own >= WORD_ALIKE and (first >= WORD_ALIKE or not given) else 0.0


# ---- the operator


def _parsed(batches):
    for pdf in batches:
        forms = [parse_person(x) if f == "first_author" else parse_journal(x) for f, x in zip(pdf["field"], pdf["name"], strict=True)]
        keep = [f is not None for f in forms]
        out = pdf[keep].copy()
        known = [f for f in forms if f is not None]
        for i, c in enumerate(("kind", "base", "given", "middle")):
            out[c] = pd.Series([f[i] for f in known], index=out.index, dtype="object")
        out["key"] = pd.Series([key_of(f[0], f[1]) for f in known], index=out.index, dtype="object")
        yield out


def _compared(batches):
    for pdf in batches:
        x = zip(pdf["kind"], pdf["base"], pdf["given"], pdf["middle"], pdf["base_n"], pdf["base_forms"], strict=True)
        y = zip(pdf["kind"], pdf["base2"], pdf["given2"], pdf["middle2"], pdf["base_n2"], pdf["base_forms2"], strict=True)
        pdf["s"] = [similarity(p, q) for p, q in zip(x, y, strict=True)]
        yield pdf.loc[pdf["s"] >= ALIKE, ["u", "v", "s"]]


def _greedy(batches):
    """The centres among a small remainder of linked forms, one after the other."""
    place: dict[str, tuple] = {}
    near: dict[str, list[str]] = {}
    for pdf in batches:
        for u, v, full, n, degree in zip(pdf["u"], pdf["v"], pdf["full"], pdf["n"], pdf["degree"], strict=True):
            place[u] = (full, n, degree, u)
            near.setdefault(u, []).append(v)
    gone: set[str] = set()
    centres = []
    for u in sorted(place, key=place.get, reverse=True):
        if u not in gone:
            centres.append(u)
            gone.update(near[u])
    yield pd.DataFrame({"u": pd.Series(centres, dtype="object")})


def stars(forms: DataFrame, links: DataFrame, core: int = CORE) -> DataFrame:
    """(form, centre): star clustering of forms (form, full, n) along links (u, v, s).

    In the order of full forms, number of rows, number of links and text, from the greatest, a form that is linked to no centre becomes one.
    Every other form is a satellite of the centre it is linked to with the greatest similarity, ties to the greater centre.
    In a round all forms that come before all their neighbours still to be placed become centres at once; when no more than
    ``core`` links are left, long chains among them, one task goes through them in order, with the same result.
    """
    both = checkpoint(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"), "s")))
    degree = both.groupBy(F.col("u").alias("form")).agg(F.count("*").alias("degree"))
    weight = checkpoint(forms.join(degree, "form").select(F.col("form").alias("u"), F.struct("full", "n", "degree", "form").alias("p")))
    live = checkpoint(both.select("u", "v").join(weight, "u").join(weight.select(F.col("u").alias("v"), F.col("p").alias("q")), "v"))
    centres, left = [], live.count()
    while left > core:
        centre = checkpoint(live.groupBy("u").agg(F.max("p").alias("p"), F.max("q").alias("q")).where("p > q").select("u"))
        centres.append(centre)
        beside = live.join(centre.select(F.col("u").alias("v")), "v", "left_semi").select("u")
        done = checkpoint(centre.unionByName(beside).distinct())
        live = checkpoint(live.join(done, "u", "left_anti").join(done.select(F.col("u").alias("v")), "v", "left_anti").select("u", "v", "p", "q"))
        left = live.count()
    if left:
        rest = live.select("u", "v", F.col("p.full").cast("int").alias("full"), "p.n", "p.degree").coalesce(1)
        centres.append(checkpoint(rest.mapInPandas(_greedy, "u string")))
    every = forms.select("form")
    if not centres:
        return every.select("form", F.col("form").alias("centre"))
    # a form whose neighbours all went to others is a centre too
    placed = functools.reduce(DataFrame.unionByName, centres).withColumnRenamed("u", "v")
    beside = both.join(placed, "v", "left_semi").select("u").distinct()
    chosen = checkpoint(every.withColumnRenamed("form", "u").join(beside, "u", "left_anti"))
    order = weight.select(F.col("u").alias("v"), F.col("p").alias("q"))
    satellites = (
        both.join(chosen.select(F.col("u").alias("v")), "v", "left_semi").join(order, "v").join(chosen, "u", "left_anti")
        .groupBy(F.col("u").alias("form")).agg(F.max_by("v", F.struct("s", "q")).alias("centre"))
    )
    return every.join(satellites, "form", "left").select("form", F.coalesce("centre", "form").alias("centre"))


def clusters(names: DataFrame) -> DataFrame:
    """(field, name, entity): every distinct spelling with the form that stands for its person, group or periodical.

    ``names`` has (field, name, n), spellings distinct in a field. Blank names and Anonymous mean nobody and have no
    row. Spellings that differ in case, accents, spacing, punctuation or order of parts have one form.
    """
    schema = "field string, name string, n long, kind string, base string, given string, middle string, key string"
    parsed = checkpoint(names.select("field", "name", F.col("n").cast("long").alias("n")).mapInPandas(_parsed, schema).withColumn(
        "form", F.concat_ws("|", "kind", "base", "given", "middle")
    ), tidy=True)
    forms = parsed.groupBy("form", "kind", "base", "given", "middle", "key").agg(F.sum("n").alias("n"))
    base = parsed.groupBy("kind", "base").agg(F.sum("n").alias("base_n"), F.count("*").alias("base_forms"))
    forms = checkpoint(forms.join(base, ["kind", "base"]), tidy=True)

    # keys that meet in a band or without a letter: only numbers are shuffled, and become keys again for the pairs that met
    keys = checkpoint(forms.select("kind", "key").distinct().withColumn("id", F.xxhash64("kind", "key")), tidy=True)
    met = meeting(keys)
    met = met.join(keys, "id").join(keys.select("kind", F.col("key").alias("key2"), F.col("id").alias("id2")), ["kind", "id2"])
    met = met.select("kind", F.least("key", "key2").alias("key"), F.greatest("key", "key2").alias("key2"))
    # what no one edit or swap can make equal needs no closer look
    met = met.where((F.col("kind") == "journal") | (F.levenshtein("key", "key2", 2) >= 0))
    own = forms.select("kind", "key").distinct().select("kind", "key", F.col("key").alias("key2"))
    second = forms.select("kind", *[F.col(c).alias(c + "2") for c in ("key", "base", "given", "middle", "base_n", "base_forms")], F.col("form").alias("v"))
    pairs = (
        forms.withColumnRenamed("form", "u").join(checkpoint(met, tidy=True).unionByName(own), ["kind", "key"]).join(second, ["kind", "key2"])
        .where("u <> v AND (key <> key2 OR u < v)")
    )
    columns = ["u", "v", "kind", "base", "given", "middle", "base_n", "base_forms", "base2", "given2", "middle2", "base_n2", "base_forms2"]
    links = checkpoint(pairs.select(*columns).mapInPandas(_compared, "u string, v string, s double"), tidy=True)
    # an initial or an abbreviation is never the centre if a full form is at hand
    full = F.when(F.col("kind") == "journal", F.length("base")).otherwise((F.length("given") > 1).cast("int"))
    weighted = forms.select("form", full.alias("full"), "n")
    weighted = weighted.withColumn("full", F.when(F.col("form").startswith("journal|"), F.lit(1)).otherwise(F.col("full")))
    found = stars(weighted, links)
    return parsed.join(found, "form").select("field", "name", F.col("centre").alias("entity"))


def spellings(records: DataFrame) -> DataFrame:
    """(field, name, n) of the distinct authors and journals that are not blank."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("name")) for f in FIELDS])).alias("x")
    return records.select(pairs).select("x.field", "x.name").where("trim(name) <> ''").groupBy("field", "name").agg(F.count("*").alias("n"))


def same_entity(records: DataFrame) -> DataFrame:
    """(field, name_a, name_b): every pair of different spellings of one entity, the smaller first."""
    found = clusters(spellings(records))
    return pairs_within(found, ["field", "entity"], "name").select("field", "name_a", "name_b")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_entity(table(spark, sf_dir, "records"))


def p2_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of each field with their numbers of spellings."""
    found = clusters(spellings(table(spark, sf_dir, "records")))
    return found.groupBy("field", "entity").agg(F.count("*").alias("n_spellings"))
