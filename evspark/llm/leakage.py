"""Evaluation texts leaking into training text (problem 9).

Method: a BM25 inverted index of the test items, in blocks with their greatest weight; every training text is a
query against it, whole, by block-max WAND, which returns all items that score above their threshold; each is then verified
by aligning the item with the text.

The threshold of an item is RETAINED of the smallest BM25 score that any stretch of SHARE of it has against the item,
so that a text with a whole stretch, or one with up to two fifths of its weight changed, is always retrieved. Weights
are stored divided by their item's threshold: a document is retrieved when it reaches 1.

The held-out items are a bounded set. They are indexed in shards of at most SHARD_CHARS characters; each shard is one
broadcast of bounded size, and a larger set takes more shards, never a larger broadcast. Documents are only mapped
over: no shuffle, and no document leaves its partition.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.runtime import checkpoint, table

#: Part of an item that makes a leak (fixed by the problem).
SHARE = 0.4
RETAINED = 0.6
PASSIVE = 0.4
#: Item words in a row that may be changed or lost inside a stretch, and the part of a stretch's weight that must be
#: found.
LOST_IN_A_ROW, FOUND = 2, 0.6
K1, B = 1.2, 0.75
BLOCK = 8
SHARD_CHARS = 8_000_000
#: Places of a word from which on they are looked at as arrays; it changes nothing but the time.
MANY = 200

_MARKUP = re.compile(r"<[^<>\n]{1,80}>|&#?\w{1,8};")
_HYPHENATED = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n[ \t>*#|]*(?=[^\W\d_])")
_INVISIBLE = ("\u00ad", "\u200b", "\u200c", "\u200d", "\ufeff")
_WORD = re.compile(r"\d+(?:[.,]\d+)+|[^\W_]+")


def words(text: str | None) -> list[str]:
    """Words without layout, markup, letter case and punctuation; a number is one word, and a word cut at the end of a line is whole again."""
    if not text:
        return []
    if "<" in text or "&" in text:
        text = _MARKUP.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        for c in _INVISIBLE:
            if c in text:
                text = text.replace(c, "")
    if "-\n" in text or "-\r" in text or "- \n" in text or "-\t" in text:
        text = _HYPHENATED.sub("", text)
    return _WORD.findall(text.lower())


@dataclass
class Index:
    ids: list[int]
    items: list[list[str]]
    idf: dict[str, float]
    #: term -> (item numbers in order, normed weights, greatest weight of each block, greatest weight)
    postings: dict[str, tuple[list[int], list[float], list[float], float]]
    terms: frozenset[str]


@dataclass
class Statistics:
    """Of all items, whatever the shard: number, mean length in words, and number of items of each term."""

    n: int
    mean: float
    df: dict[str, int]

    @classmethod
    def of(cls, items: list[tuple[int, str]]) -> Statistics:
        own = [w for _, t in items if (w := words(t))]
        return cls(len(own), sum(map(len, own)) / max(1, len(own)), Counter(t for w in own for t in set(w)))


def build(items: list[tuple[int, str]], known: Statistics | None = None) -> Index:
    known = known or Statistics.of(items)
    pairs = [(i, w) for i, t in sorted(items) if (w := words(t))]
    idf = {t: math.log(1 + (known.n - known.df[t] + 0.5) / (known.df[t] + 0.5)) for _, w in pairs for t in w}
    lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
    for x, (_, w) in enumerate(pairs):
        tf, norm = Counter(w), K1 * (1 - B + B * len(w) / known.mean)
        weight = {t: idf[t] * k * (K1 + 1) / (k + norm) for t, k in tf.items()}
        size = max(1, math.ceil(SHARE * len(w)))
        least = min(sum(weight[t] for t in set(w[s : s + size])) for s in range(len(w) - size + 1))
        for t, v in weight.items():
            lists[t].append((x, v / (RETAINED * least)))
    postings = {}
    for t, entries in lists.items():
        weights = [v for _, v in entries]
        blocks = [max(weights[s : s + BLOCK]) for s in range(0, len(weights), BLOCK)]
        postings[t] = ([x for x, _ in entries], weights, blocks, max(weights))
    return Index([i for i, _ in pairs], [w for _, w in pairs], idf, postings, frozenset(postings))


def retrieve(index: Index, terms: set[str]) -> list[int]:
    """Numbers of all items that score 1 or more for the query, by block-max WAND.

    The weakest terms, which together can add PASSIVE at most, lead to no item; they only add to the score of those
    that the others lead to.
    """
    lists = sorted((index.postings[t] for t in terms), key=lambda p: p[3])
    passive, rest, k = 0.0, sum(p[3] for p in lists), 0
    if rest < 1:
        return []
    while passive + lists[k][3] <= PASSIVE:
        passive += lists[k][3]
        k += 1
    need, end = 1 - passive, len(index.ids)
    # a cursor: item, its number among the cursors, place, items, weights, block bounds, bound
    cursors = [[p[0][0], i, 0, *p] for i, p in enumerate(lists[k:])]
    out = []
    while True:
        cursors.sort()
        bound, pivot = 0.0, end
        for c in cursors:
            bound += c[6]
            if bound >= need:
                pivot = c[0]
                break
        if pivot == end:
            return out
        # the blocks that can hold the pivot give a closer bound, which holds up to where the first of them ends
        close, target = 0.0, end
        for c in cursors:
            if c[0] > pivot:
                target = min(target, c[0])
                break
            items = c[3]
            j = c[2] if c[0] == pivot else bisect_left(items, pivot, c[2])
            if j < len(items):
                block = j // BLOCK
                close += c[5][block]
                target = min(target, items[min(len(items), (block + 1) * BLOCK) - 1] + 1)
        if close >= need:
            score = 0.0
            for c in cursors:
                if c[0] > pivot:
                    break
                j = bisect_left(c[3], pivot, c[2])
                if j < len(c[3]) and c[3][j] == pivot:
                    score += c[4][j]
            if score >= need:
                for items, weights, _, _ in lists[:k]:
                    j = bisect_left(items, pivot)
                    if j < len(items) and items[j] == pivot:
                        score += weights[j]
                if score >= 1:
                    out.append(pivot)
            target = pivot + 1
        for c in cursors:
            if c[0] >= target:
                break
            j = c[2] = bisect_left(c[3], target, c[2])
            c[0] = c[3][j] if j < len(c[3]) else end


def _chains(places: list[int], before: list[tuple], w: float, p: int) -> list[tuple]:
    out = []
    for place in places:
        chain = (w, p, w)
        for earlier, chains, lost in before:
            k = bisect_left(earlier, place)
            if k and (c := chains[k - 1])[0] - lost > chain[0] - w:
                chain = (c[0] - lost + w, c[1], c[2] + w)
        out.append(chain)
    return out


def _chains_of_many(places: list[int], before: list[tuple], w: float, p: int) -> list[tuple]:
    """The same for a word with very many places, in arrays."""
    at = np.asarray(places)
    score, first, weight = np.full(len(at), w), np.full(len(at), p), np.full(len(at), w)
    for earlier, chains, lost in before:
        k = np.searchsorted(np.asarray(earlier), at)
        of = np.array([(-np.inf, 0, 0.0), *chains])[k]
        better = of[:, 0] - lost > score - w
        score = np.where(better, of[:, 0] - lost + w, score)
        first, weight = np.where(better, of[:, 1].astype(int), first), np.where(better, of[:, 2] + w, weight)
    return list(zip(score.tolist(), first.tolist(), weight.tolist(), strict=True))


def stretch(item: list[str], where: dict[str, list[int]], idf: dict[str, float]) -> float:
    """The part of the item covered by its best stretch: item words found in the item's order, text between them
    allowed, at most LOST_IN_A_ROW words in a row lost.

    A local alignment: found words add their weight, lost ones take it away, so that a frame of common words around
    other names and numbers does not add up. ``where`` has the places of each word, in order.
    """
    none: tuple = ([], [])
    rows = [none] * len(item)  # of each item word: its places, and the best chain that ends at or before each place
    cost = [0.0]
    for t in item:
        cost.append(cost[-1] + idf[t])
    best = 0
    for p, t in enumerate(item):
        places = where.get(t)
        if not places:
            continue
        w = idf[t]
        before = [(*rows[q], cost[p] - cost[q + 1]) for q in range(max(0, p - LOST_IN_A_ROW - 1), p) if rows[q][0]]
        # chains that end at each place: score, their first item word, weight found
        chains = _chains_of_many(places, before, w, p) if len(places) >= MANY else _chains(places, before, w, p)
        if any(p + 1 - c[1] > best and c[2] >= FOUND * (cost[p + 1] - cost[c[1]]) for c in set(chains)):
            best = max(p + 1 - c[1] for c in set(chains) if c[2] >= FOUND * (cost[p + 1] - cost[c[1]]))
        tops, top = [], (-1.0, p, 0.0)
        for chain in chains:
            if chain[0] > top[0]:
                top = chain
            tops.append(top)
        rows[p] = (places, tops)
    return best / len(item)


def may_hold(item: list[str], terms: set[str], idf: dict[str, float], share: float) -> bool:
    """False if no stretch can do.

    A stretch of the least length or more falls into parts of between that length and twice that length; of one of
    them at least as great a part of the weight must be found as of the whole.
    """
    weight = np.array([idf[t] for t in item])
    present = np.fromiter((t in terms for t in item), bool, len(item))
    surplus = np.concatenate(([0.0], np.cumsum(weight * (present - FOUND))))
    least = max(1, math.ceil(share * len(item)))
    return any(
        (surplus[size:] >= surplus[: len(surplus) - size] - 1e-9).any()
        for size in range(least, min(2 * least, len(item) + 1))
    )


def held_items(index: Index, text: str | None, share: float = SHARE) -> list[tuple[int, float]]:
    """(item id, part held) of the items of which the text holds at least ``share``."""
    tokens = words(text)
    terms = index.terms.intersection(tokens)
    hits = [x for x in retrieve(index, terms) if may_hold(index.items[x], terms, index.idf, share)]
    if not hits:
        return []
    where: dict[str, list[int]] = defaultdict(list)
    for q, t in enumerate(tokens):
        if t in terms:
            where[t].append(q)
    parts = [(index.ids[x], stretch(index.items[x], where, index.idf)) for x in hits]
    return sorted((i, part) for i, part in parts if part >= share)


def _terms(batches):
    """(shard, term, NULL) for each term of an item, and (shard, NULL, words) for the item itself."""
    for pdf in batches:
        rows = []
        for shard, text in zip(pdf["shard"], pdf["text"], strict=True):
            if w := words(text):
                rows += [(shard, t, None) for t in sorted(set(w))] + [(shard, None, len(w))]
        yield pd.DataFrame(rows, columns=["shard", "term", "size"]).astype({"size": "Int64"})


def leaks(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, part): every document and test item of which it holds at least ``share``.

    ``documents`` has (doc_id, text), ``benchmark`` (item_id, text); other columns are ignored. Null and empty texts
    hold nothing and are held by nothing; repeated documents are reported each, repeated (doc_id, item_id) once.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = math.ceil(chars / SHARD_CHARS)
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id"), F.lit(max(1, shards))).cast("int"))
    schema = "doc_id long, item_id long, part double"
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    if shards > 1:  # statistics of all items, of which each shard takes those of its own terms
        terms = items.mapInPandas(_terms, "shard int, term string, size long")
        of = terms.where("term IS NULL").agg(F.count("*").alias("n"), F.avg("size").alias("mean")).first()
        df = terms.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("df"))
        own_df = checkpoint(terms.where("term IS NOT NULL").select("shard", "term").distinct().join(df, "term"))
    out = None
    for shard in range(shards):
        own = items.where(F.col("shard") == shard).collect()  # bounded by SHARD_CHARS
        known = Statistics(of.n, of.mean, {r.term: r.df for r in own_df.where(F.col("shard") == shard).collect()}) if shards > 1 else None
        index = spark.sparkContext.broadcast(build([(r.item_id, r.text) for r in own], known))

        def search(batches, index=index):
            known = index.value
            for pdf in batches:
                rows = [
                    (d, i, part) for d, t in zip(pdf["doc_id"], pdf["text"], strict=True) for i, part in held_items(known, t, share)
                ]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "part"]).astype({"doc_id": "int64", "item_id": "int64", "part": "float64"})

        found = docs.mapInPandas(search, schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], schema)
    return out.groupBy("doc_id", "item_id").agg(F.max("part").alias("part"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id")


def p9_leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each leaked item the number of documents that hold it and the largest part that one holds."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("item_id").agg(F.count("*").alias("n_documents"), F.round(F.max("part"), 4).alias("largest_part"))
