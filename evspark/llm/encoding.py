"""Garbled text from wrong character encoding (problem 1).

Method: noisy-channel decoding. The corpus gives word and letter frequencies. Every distinct word with letters beyond
ASCII is a byte lattice: a path takes a byte sequence of UTF-8 as the letter it stands for, a lead byte whose continuation
was lost as any letter that begins so, a replacement character, or up to three, as any one letter, or a character as it
stands. Two Viterbi searches go over it:

* under the word frequencies of the corpus, with the lost bytes as wildcards: the words that agree in their ASCII letters
  are joined, and the path to each is as good as its channel cost and the word's frequency say. This settles words with
  lost bytes, of which no reading can be written down without the corpus;
* under letter frequencies, code page by code page, for the readings of whole sequences (and those of one byte a letter),
  also of words without any ASCII letter, whose frequencies are looked up.

The reading with the greatest corpus frequency wins if it clearly beats the word as it stands. A replacement character
between words of the corpus is a lost space.

All of it runs on distinct words: counting combines before the shuffle, so a word that makes up a third of all text
is one row, and values are only touched again where they contain a garbled word.
"""

from __future__ import annotations

import math
import re
import string
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.runtime import checkpoint, lookup_join, table

FIELDS = ("title", "abstract")
LOST = "�"
#: A reading must be this many times as frequent as the word as it stands, and occur this often; SURE is for words
#: that say little.
RATIO, LEAST = 2, 2
SURE = 20
#: Cost of a letter from a cut sequence, of a character kept as it stands, and what an unknown word must gain a letter.
CUT_COST, KEEP_COST, GAIN = 4.0, 0.5, 0.7
#: Costs of a letter for one, two or three replacement characters: a lost byte each, or a letter each.
LOST_COSTS = {1: 1.0, 2: 1.5, 3: 2.0}

#: Code pages a text may have been decoded with by mistake, and those of one byte a letter it may really have had.
WRONG = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "mac_roman", "cp437", "cp850", "cp852", "cp866", "koi8-r", "iso8859-2", "iso8859-15")
#: The latter with the pages they are known to be taken for.
RIGHT = {
    "cp1252": ("cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "mac_roman", "cp437", "cp850", "koi8-r"),
    "cp1250": ("cp1252", "latin-1", "cp1251", "mac_roman", "cp852"),
    "cp1251": ("cp1252", "latin-1", "mac_roman", "koi8-r", "cp866"),
    "koi8-r": ("cp1252", "latin-1", "cp1251"),
    "cp866": ("cp1252", "latin-1", "cp1251"),
    "mac_roman": ("cp1252", "latin-1"),
    "cp850": ("cp1252", "latin-1"),
}


@lru_cache(maxsize=None)
def _bytes_of(page: str) -> dict[str, int]:
    """Character to byte; bytes the page leaves undefined stand for the control characters of the same number."""
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(page)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    if page == "cp1252":
        for b in range(128, 160):
            out.setdefault(chr(b), b)
    return out


@lru_cache(maxsize=None)
def _chars_of(page: str) -> dict[int, str]:
    return {b: bytes([b]).decode(page, "replace") for b in range(128, 256)}


class Letters:
    """Letter costs from corpus counts, and the frequent letters of each UTF-8 lead byte."""

    def __init__(self, counts: dict[str, int]):
        self.total = sum(counts.values()) + 1
        self.counts = counts
        self.floor = math.log(self.total * 20)
        self.after: dict[tuple, str] = {}
        for c, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
            raw = c.encode("utf-8", "surrogatepass")
            for k in range(1, len(raw)):
                self.after.setdefault(tuple(raw[:k]), c)

    def cost(self, c: str) -> float:
        n = self.counts.get(c)
        return math.log(self.total / n) if n else self.floor


def _units(codes: list[int | None], i: int, letters: Letters):
    """Arcs from place i: (next place, character, cost)."""
    lead = codes[i]
    if lead is None or not 0xC2 <= lead <= 0xF4:
        return
    size = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    tail = []
    for k in range(1, size):
        b = codes[i + k] if i + k < len(codes) else None
        if b is None or not 0x80 <= b < 0xC0:
            break
        tail.append(b)
    if len(tail) == size - 1:
        try:
            c = bytes([lead, *tail]).decode("utf-8")
        except UnicodeDecodeError:
            return
        yield i + size, c, letters.cost(c)
    elif c := letters.after.get((lead, *tail)):
        yield i + 1 + len(tail), c, letters.cost(c) + CUT_COST


def viterbi(word: str, page: str, letters: Letters) -> tuple[str, bool]:
    """The cheapest reading of a word under one code page, and whether no byte of it was lost."""
    table_ = _bytes_of(page)
    codes: list[int | None] = [None if c < "\x80" else table_.get(c) for c in word]
    n = len(word)
    best: list[tuple[float, str, bool] | None] = [None] * (n + 1)
    best[0] = (0.0, "", True)
    for i in range(n):
        if (here := best[i]) is None:
            continue
        cost = 0.0 if word[i] < "\x80" else letters.cost(word[i]) + KEEP_COST
        arcs = [(i + 1, word[i], cost, True)]
        arcs += [(j, c, w, w < letters.cost(c) + CUT_COST / 2) for j, c, w in _units(codes, i, letters)]
        for j, c, w, whole in arcs:
            new = (here[0] + w, here[1] + c, here[2] and whole)
            if best[j] is None or new[0] < best[j][0]:
                best[j] = new
    assert best[n] is not None
    return best[n][1], best[n][2]


def _begins(letter: str, raw: list[int]) -> bool:
    return letter >= "\x80" and letter.encode("utf-8", "surrogatepass")[: len(raw)] == bytes(raw)


def channel_cost(word: str, truth: str) -> tuple[float, bool] | None:
    """The cost of the cheapest path through the lattice of ``word`` that reads ``truth``, whatever the case of its letters, and
    whether it takes a wildcard; None if there is no path. A Viterbi search along both words at once."""
    low = truth.lower()
    codes = [None if c < "\x80" else _bytes_of("cp1252").get(c, ord(c) if ord(c) < 256 else None) for c in word]
    best: list[dict[int, tuple[float, bool]]] = [{} for _ in range(len(word) + 1)]
    best[0][0] = (0.0, False)

    def reach(i: int, j: int, new: tuple[float, bool]) -> None:
        if j not in best[i] or new < best[i][j]:
            best[i][j] = new

    for i, c in enumerate(word):
        for j, (cost, wild) in best[i].items():
            if j == len(low):
                continue
            want = low[j]
            if c == LOST:
                for k, w in LOST_COSTS.items():
                    if word[i : i + k] == LOST * k and want >= "\x80":
                        reach(i + k, j + 1, (cost + w, True))
                continue
            if c.lower() == want:
                reach(i + 1, j + 1, (cost + (KEEP_COST if c >= "\x80" else 0.0), wild))
            lead = codes[i]
            if lead is None or not 0xC2 <= lead <= 0xF4:
                continue
            size, raw = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4, [lead]
            while len(raw) < size and i + len(raw) < len(word) and 0x80 <= (codes[i + len(raw)] or 0) < 0xC0:
                raw.append(codes[i + len(raw)])
            if _begins(want, raw) or _begins(want.upper(), raw):
                cut = len(raw) < size
                reach(i + len(raw), j + 1, (cost + (CUT_COST if cut else 0.0), wild or cut))
        best[i] = {}
    return best[-1].get(len(low))


def like(word: str, truth: str) -> str:
    """The true word with the capitals of the damaged one."""
    if word.isupper() and len(word) > 1:
        return truth.upper()
    return truth[:1].upper() + truth[1:] if word[:1].isupper() else truth


def readings(word: str, letters: Letters) -> dict[str, tuple[bool, bool]]:
    """Other readings of a word: {reading: (whether several bytes became one letter, whether nothing was lost)}."""
    out: dict[str, tuple[bool, bool]] = {}
    layer = {word: True}
    for _ in range(3):  # text may have been decoded wrongly up to three times
        new: dict[str, bool] = {}
        for w, whole in layer.items():
            for page in WRONG:
                c, sound = viterbi(w, page, letters)
                if c != w and c not in out:
                    new[c] = max(new.get(c, False), whole and sound)
        for c, whole in new.items():
            out[c] = (True, whole)
        layer = new
    for page in WRONG[:2]:  # the last byte was a no-break space, and was taken for white space
        lead = _bytes_of(page).get(word[-1], 0)
        if 0xC2 <= lead <= 0xDF:
            out.setdefault(viterbi(word[:-1], page, letters)[0] + bytes([lead, 0xA0]).decode(), (True, False))
    own = [c for c in word if c >= "\x80"]
    for right, pages in RIGHT.items():
        chars = _chars_of(right)
        for wrong in pages:
            codes = _bytes_of(wrong)
            if all(c in codes for c in own):
                c = "".join(x if x < "\x80" else chars[codes[x]] for x in word)
                if not (c[-1] == "\xa0" and word[-1].isalpha()):  # a cut word, not one with a space behind
                    out.setdefault(c, (False, True))
    return {c: x for c, x in out.items() if c != word and LOST not in c and plausible(c)}


def plausible(reading: str) -> bool:
    """Whether a text can hold such a word: no controls or box drawing, no Cyrillic letters among Latin ones, and no
    no-break space that leaves a single letter on one side."""
    if any(c.isspace() or (c > "\x7f" and not c.isprintable()) or "\u2500" <= c <= "\u259f" for c in reading.replace("\xa0", "")):
        return False
    if re.search("[A-Za-z]", reading) and re.search("[\u0400-\u04ff]", reading):
        return False
    parts = reading.split("\xa0")
    return len(parts) == 1 or all(len(p) != 1 or not p.isalpha() or p.lower() in "aeoyàéióuвиксу" for p in parts)


# ---- words of the corpus

def words(text: Column, only=None) -> Column:
    """The words of a text, or only those for which a condition holds, with digits as 0 and without ASCII punctuation around.

    A no-break space parts words unless it follows a character beyond ASCII, with which it may be one letter.
    """
    parts = F.split(F.translate(text, "123456789", "000000000"), r"[\x00-\x20]+|(?<![^\x00-\x7F])\u00A0+")
    return F.transform(F.filter(parts, only) if only else parts, lambda w: F.btrim(w, F.lit(string.punctuation)))


def _beyond_ascii(column: Column) -> Column:
    return column.rlike(r"[^\x00-\x7F]")


def skeleton(column: Column) -> Column:
    """The ASCII letters of a word, with one mark for each run of others."""
    return F.lower(F.regexp_replace(column, r"[^\x00-\x7F]+", "\x01"))


def values(records: DataFrame) -> DataFrame:
    """(record_id, field, text), one row per title and abstract that isn't missing."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in FIELDS])
    return records.select("record_id", F.explode(pairs).alias("x")).select("record_id", "x.field", "x.text").where("text <> ''")


def word_counts(text: DataFrame) -> DataFrame:
    """(word, low, n): ASCII words in small letters, others as they stand; ``low`` is the word in small letters."""
    w = F.explode(words(F.col("text"))).alias("word")
    exploded = text.select(w).where("word <> ''")
    return (
        exploded.select(F.when(_beyond_ascii(F.col("word")), F.col("word")).otherwise(F.lower("word")).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n")).withColumn("low", F.lower("word"))
    )


#: Characters that stand for lead bytes of UTF-8 in the commonest pages.
LEAD = "[\u00c2-\u00f4]"
_OUTER = re.compile(r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$")


def _readings(letters):
    def run(batches):
        known = letters.value
        for pdf in batches:
            rows = []
            for w in pdf["word"]:
                for c, (several, whole) in readings(w, known).items():
                    gain = (sum(map(known.cost, (x for x in w if x >= "\x80"))) - sum(map(known.cost, (x for x in c if x >= "\x80")))) / max(1, len(w))
                    parts = [p for x in re.split("[\xa0\\s]+", c.lower()) if (p := _OUTER.sub("", x))]
                    rows += [(w, c, several, whole, gain, len(parts), p) for p in parts or [""]]
            yield pd.DataFrame(rows, columns=["word", "reading", "several", "whole", "gain", "n_parts", "low"])

    return run


def _paths(batches):
    """Of damaged words and words of the corpus those that a path with a wildcard joins, with the logarithm of their odds."""
    for pdf in batches:
        rows = []
        for w, v, n in zip(pdf["word"], pdf["truth"], pdf["n"], strict=True):
            if (path := channel_cost(w, v)) is not None and path[1]:
                rows.append((w, like(w, v), n, math.log(n) - path[0]))
        yield pd.DataFrame(rows, columns=["word", "reading", "n", "score"])


def garbled_words(counts: DataFrame) -> DataFrame:
    """(word, reading, lossless): garbled words as they stand, with the best reading (NULL if there is none) and
    whether it gives back what stood there without a guess. ``counts`` comes from ``word_counts``."""
    by_low = counts.groupBy("low").agg(F.sum("n").alias("n"))
    other = checkpoint(counts.where(_beyond_ascii(F.col("word"))).join(by_low.withColumnRenamed("n", "own"), "low"))
    # one row per character of Unicode at most
    chars = other.select(F.explode(F.split("word", "")).alias("c"), "n").where(_beyond_ascii(F.col("c"))).groupBy("c").agg(F.sum("n").alias("n"))
    letters = counts.sparkSession.sparkContext.broadcast(Letters({r.c: r.n for r in chars.collect()}))

    schema = "word string, reading string, several boolean, whole boolean, gain double, n_parts int, low string"
    # a fixed number of partitions: the bytes of a word say nothing of what its readings cost
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = other.where(~F.col("word").contains(LOST)).select("word").repartition(parts, "word").mapInPandas(_readings(letters), schema)
    scored = (
        spread.join(by_low, "low", "left")
        .groupBy("word", "reading", "several", "whole", "gain", "n_parts")
        .agg(F.min(F.coalesce("n", F.lit(0))).alias("n"))
        .join(other.select("word", "own"), "word")
    )
    # a word of one character has little to go by, and a reading that parts the word takes two frequent words
    single = F.length("word") == 1
    ratio = F.when(single | (F.col("n_parts") > 1), SURE).otherwise(RATIO)
    foreign = single & F.col("reading").rlike(r"[\u0370-\u04FF]")
    frequent = (F.col("n") >= LEAST) & (F.col("n") >= ratio * F.col("own")) & ~foreign
    mixed = F.col("word").rlike("[A-Za-z]")
    unknown = F.col("several") & F.col("whole") & mixed & (F.col("gain") * F.length("word") >= GAIN * F.length(F.regexp_replace("word", r"[\x00-\x7F]", "")))
    decoded = scored.where(frequent | unknown).select(
        "word", "reading", "n", F.when(frequent, 1).otherwise(0).alias("known"), "gain", F.col("whole").alias("lossless")
    )
    best = decoded.groupBy("word").agg(F.max_by(F.struct("reading", "lossless", "known"), F.struct("known", "lossless", "n", "gain", "reading")).alias("b"))
    settled = checkpoint(best.select("word", "b.*"))
    found = settled.select("word", "reading", "lossless")

    # words that may have lost bytes: with a replacement character, or a lead byte where no whole reading is a word of the corpus
    lost = F.col("word").contains(LOST)
    doubtful = other.where(lost | F.col("word").rlike(LEAD)).select("word", "own").join(settled.where("lossless AND known = 1").select("word"), "word", "left_anti")
    shaped = other.where(~lost).select(F.col("word").alias("truth"), "n", skeleton(F.col("word")).alias("shape"))
    paths = (
        doubtful.withColumn("shape", skeleton(F.col("word"))).where(F.col("shape").rlike("[a-z0]")).join(shaped, "shape").where("word <> truth")
        .select("word", "truth", "n", "own").where(lost | ((F.col("n") >= LEAST) & (F.col("n") >= RATIO * F.col("own"))))
        .select("word", "truth", "n").mapInPandas(_paths, "word string, reading string, n long, score double")
        .groupBy("word").agg(F.max_by("reading", F.struct("score", "n", "reading")).alias("reading"))
    )
    searched = checkpoint(doubtful.select("word").join(paths, "word", "left"))
    # replacement characters between words of the corpus are lost spaces
    apart = searched.where(lost & F.col("reading").isNull()).select("word", F.explode(F.split("word", LOST + "+")).alias("part"))
    apart = apart.select("word", F.lower(F.btrim("part", F.lit(string.punctuation + "“”„‘’«»–—"))).alias("low")).where("low <> ''")
    spaced = apart.join(by_low, "low", "left").groupBy("word").agg(F.min(F.coalesce("n", F.lit(0))).alias("least"), F.count("*").alias("parts"))
    spaced = spaced.where((F.col("least") >= LEAST) & (F.col("parts") > 1)).select("word", F.regexp_replace("word", LOST, "\u00a0").alias("spaced"))
    told = searched.join(spaced, "word", "left").select("word", F.coalesce("reading", "spaced").alias("reading"), F.lit(False).alias("lossless"))
    told = told.where(lost | F.col("reading").isNotNull())
    return found.join(told.select("word"), "word", "left_anti").unionByName(told)


def garbled_values(records: DataFrame) -> DataFrame:
    """(record_id, field, text, repairs): values with a garbled word; ``repairs`` lists (word, reading, lossless)."""
    text = values(records)
    counts = checkpoint(word_counts(text))
    bad = checkpoint(garbled_words(counts))
    own = text.where(_beyond_ascii(F.col("text"))).select("record_id", "field", F.explode(F.array_distinct(words(F.col("text"), _beyond_ascii))).alias("word"))
    hits = lookup_join(own, bad, "word", counts.where(_beyond_ascii(F.col("word"))), "inner")
    repairs = hits.groupBy("record_id", "field").agg(F.sort_array(F.collect_list(F.struct("word", "reading", "lossless"))).alias("repairs"))
    return text.join(repairs, ["record_id", "field"])


_PARTS = re.compile(r"([\x00-\x20]+|(?<![^\x00-\x7f])\u00a0+)")
_CORE = re.compile(r"^([!-/:-@\[-`{-~]*)(.*?)([!-/:-@\[-`{-~]*)$", re.S)


def repaired(text: str, known: dict[str, str]) -> str:
    """The text with every garbled word replaced; digits stay what they are."""
    out = []
    for part in _PARTS.split(text):
        before, core, after = _CORE.match(part).groups()
        reading = known.get(re.sub("[0-9]", "0", core))
        if reading:
            digits = iter(re.findall("[0-9]", core))
            core = re.sub("0", lambda _, d=digits: next(d, "0"), reading)
        out.append(before + core + after)
    return "".join(out)


def _repaired(batches):
    for pdf in batches:
        pdf["restored"] = [
            repaired(text, {r["word"]: r["reading"] for r in repairs if r["reading"]})
            for text, repairs in zip(pdf["text"], pdf["repairs"], strict=True)
        ]
        pdf["lossless"] = [all(r["lossless"] for r in repairs) for repairs in pdf["repairs"]]
        yield pdf[["record_id", "field", "text", "restored", "lossless"]]


def restore(records: DataFrame) -> DataFrame:
    """(record_id, field, text, restored, lossless): garbled titles and abstracts with their text as it was.

    ``lossless`` says that nothing of the original was lost; otherwise lost letters are the most frequent ones that
    fit, or stay lost. Null and empty values are no values; rows with one record_id are one record. Other columns are
    ignored.
    """
    schema = "record_id string, field string, text string, restored string, lossless boolean"
    return garbled_values(records).mapInPandas(_repaired, schema)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore(table(spark, sf_dir, "records")).select("record_id", "field").distinct()


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore(table(spark, sf_dir, "records"))
