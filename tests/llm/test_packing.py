import random

import pytest

from evspark.llm import packing


@pytest.mark.parametrize("seed", range(5))
def test_best_two_fit(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(1, 100), rng.randint(30, 60), 50]) for _ in range(rng.randint(0, 400))]
    bins = packing.best_two_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
    first_fit = []
    for s in sorted(sizes, reverse=True):
        for k, f in enumerate(first_fit):
            if f + s <= 100:
                first_fit[k] += s
                break
        else:
            first_fit.append(s)
    assert len(bins) <= len(first_fit) + 1


def test_two_replace_the_smallest():
    assert packing.best_two_fit([6, 3, 2, 2], 10) == [[0, 2, 3], [1]]
    assert packing.best_two_fit([], 10) == [] and packing.best_two_fit([10, 10], 10) == [[0], [1]]


def test_containers(spark, rows):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["walking", "mood", "the", "of", "größe"]) for _ in range(rng.randint(1, 90))) for _ in range(300)] + [None, "", "word " * 500, "<|endoftext|> x", "日本語" * 40]
    df = spark.createDataFrame([(i % 290 if i < 300 else 1000 + i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, container int")
    out = rows(packing.containers(df, capacity=128, pool_tokens=3000))
    encode = packing.tokenizer(packing.VOCABULARY).encode_ordinary
    assert sum(r["n_tokens"] for r in out) == sum(len(encode(t)) for t in texts if t)
    fill = {}
    for r in out:
        fill[r["container"]] = fill.get(r["container"], 0) + r["n_tokens"]
    whole = packing.best_two_fit([r["n_tokens"] for r in out], 128)
    assert max(fill.values()) <= 128 and len(fill) <= len(whole) * 1.05 + 2
    long = sorted((r["piece"], r["first_token"], r["n_tokens"]) for r in out if r["doc_id"] == 1302)
    n = len(encode("word " * 500))
    assert long == [(k, a, min(128, n - a)) for k, a in enumerate(range(0, n, 128))]
    assert rows(packing.containers(df.limit(0))) == [] and rows(packing.containers(df.where("text IS NULL"))) == []
