"""Filling fixed-capacity containers with texts (problem 8).

Method: best-two-fit. A container is filled greedily with the largest text that still fits; when none fits, its
smallest text is taken out again if two texts not packed yet fit the gap so expanded more tightly, as often as that
helps. Sizes are tokens of a public tokenizer. A text larger than a container is cut into pieces of the capacity,
the last one shorter; no other text is cut.

Only sizes leave the tokenizer: (doc_id, piece, first token, tokens). They are dealt at random to pools of about
POOL_TOKENS tokens, each packed by one task; containers that stay too empty are taken apart, and their texts are dealt
and packed again. The size of a pool is fixed, so the number of pools grows with the input and the work of a task
does not.
"""

from __future__ import annotations

import base64
import math
from bisect import bisect_right, insort
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.runtime import checkpoint, table

CAPACITY = 2048
#: Rank file of the tokenizer, and the pattern that cuts texts before merging.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
POOL_TOKENS = 2_000_000
#: Containers filled less than this are packed again, in so many rounds in all.
TOO_EMPTY, ROUNDS = 0.98, 3


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _pieces(capacity: int, vocabulary: str):
    def run(batches):
        encode = tokenizer(vocabulary).encode_ordinary
        place = 0
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = len(encode(text)) if text else 0
                place += 1
                rows += [(d, k, first, min(capacity, n - first), place) for k, first in enumerate(range(0, n, capacity))]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[2:]]],
                ["doc_id", "piece", "first_token", "n_tokens", "place"],
            )

    return run


def best_two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers as lists of positions in ``sizes``; no size may exceed the capacity.

    Ties go to the position given first.
    """
    stock: dict[int, list[int]] = defaultdict(list)
    for i in range(len(sizes) - 1, -1, -1):
        stock[sizes[i]].append(i)
    open_sizes = sorted(stock)

    def take(size: int) -> int:
        i = stock[size].pop()
        if not stock[size]:
            open_sizes.remove(size)
        return i

    def give(i: int) -> None:
        if not stock[sizes[i]]:
            insort(open_sizes, sizes[i])
        stock[sizes[i]].append(i)

    bins = []
    while open_sizes:
        own = [take(open_sizes[-1])]
        gap = capacity - sizes[own[0]]
        while gap > 0 and open_sizes:
            k = bisect_right(open_sizes, gap)
            if k:
                i = take(open_sizes[k - 1])
                own.append(i)
                gap -= sizes[i]
                continue
            least = min(own, key=lambda i: (sizes[i], i))
            room = gap + sizes[least]
            known = np.array(open_sizes[: bisect_right(open_sizes, room - 1)])
            if not len(known):
                break
            j = np.searchsorted(known, np.minimum(room - known, known), "right") - 1
            single = (j >= 0) & (known[j] == known) & np.array([len(stock[s]) < 2 for s in known.tolist()])
            j = np.where(single, j - 1, j)
            sums = np.where(j >= 0, known + known[j], -1)
            best = int(sums.argmax())
            if sums[best] <= sizes[least]:
                break
            pair = [take(int(known[best])), take(int(known[j[best]]))]
            own.remove(least)
            give(least)
            own += pair
            gap = room - int(sums[best])
        bins.append(own)
    return bins


def _packed(capacity: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "place"], kind="stable").reset_index(drop=True)
        number, fill = np.empty(len(pdf), dtype=np.int64), np.empty(len(pdf))
        sizes = pdf["n_tokens"].tolist()
        for b, own in enumerate(best_two_fit(sizes, capacity)):
            number[own] = b
            fill[own] = sum(sizes[i] for i in own) / capacity
        return pdf[["doc_id", "piece", "first_token", "n_tokens", "place"]].assign(pool=key[0], number=number, fill=fill)

    return run


def containers(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """(doc_id, piece, first_token, n_tokens, container): the container of each text, or of each piece of one that is
    larger than the capacity.

    ``documents`` has (doc_id, text); other columns are ignored. Null and empty texts take no room and have no row;
    rows that share a doc_id are packed each. An empty table gives an empty one.
    """
    schema = "doc_id long, piece int, first_token long, n_tokens long, place long"
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    todo = checkpoint(narrow.mapInArrow(_pieces(capacity, vocabulary), schema))
    done = None
    for r in range(ROUNDS):
        pools = max(1, math.ceil((todo.agg(F.sum("n_tokens")).first()[0] or 0) / pool_tokens))
        last = r == ROUNDS - 1 or pools == 1
        packed = checkpoint(
            todo.withColumn("pool", F.pmod(F.xxhash64("doc_id", "piece", "place", F.lit(r)), F.lit(pools)))
            .groupBy("pool").applyInPandas(_packed(capacity), schema + ", pool long, number long, fill double")
            .withColumn("container", F.lit(r << 56) + F.shiftleft(F.col("pool"), 24) + F.col("number"))
        )
        kept = packed if last else packed.where(F.col("fill") >= TOO_EMPTY)
        done = kept if done is None else done.unionByName(kept)
        if last:
            break
        todo = packed.where(F.col("fill") < TOO_EMPTY).select("doc_id", "piece", "first_token", "n_tokens", "place")
    return done.select("doc_id", "piece", "first_token", "n_tokens", "container")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers(table(spark, sf_dir, "documents"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many containers are filled to which tenth of a percent, rounded down."""
    filled = p8_containers(spark, sf_dir).groupBy("container").agg((F.sum("n_tokens") / CAPACITY).alias("fill"))
    return filled.groupBy((F.floor(F.col("fill") * 1000) / 10).alias("percent")).agg(F.count("*").alias("n_containers"))
