"""The n-gram Jaccard join on sets made to lose links: cores, chains, templates."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from llm.test_minhash import DOCS, brute, found, mutated

from changeflow.llm import jaccard


def expected(docs):
    return [(d, n, c) for d, n, c, _ in brute(docs, 75, 5)]


def test_two_documents_that_meet_only_beside_the_centres(spark):
    core, own = [f"c{i}" for i in range(92)], lambda k: [f"x{k}w{i}" for i in range(12)]
    texts = [core + own(1), core + own(2), core[:48], core[44:]]
    docs = [(i + 1, " ".join(t)) for i, t in enumerate(texts)]
    got = found(jaccard.near_duplicates(spark.createDataFrame(docs, DOCS)))
    assert got == expected(docs)
    assert got[0][2] == got[1][2] == 1


def adversarial(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(6):  # copies of one text at and around the threshold, in clusters that do not quite meet
        words = rng.choices(vocabulary, k=rng.choice([20, 80, 300]))
        for share in (0.005, 0.02, 0.03, 0.05):
            near = mutated(rng, words, share)
            texts += [mutated(rng, near, rng.choice([0.003, 0.01, 0.03])) for _ in range(6)]
            texts += [near[k:] for k in (2, 5, 9)] + [near[: -k or None] for k in (1, 4, 8)]
    template = rng.choices(vocabulary, k=84)
    texts += [template + [f"own{i}x{j}" for j in range(16)] for i in range(150)]
    chain = rng.choices(vocabulary, k=400)
    texts += [chain[k : k + 150] for k in range(0, 250, 15)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rounds", [0, jaccard.ROUNDS])
def test_adversarial_sets_agree_with_all_pairs(spark, monkeypatch, seed, rounds):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    docs = adversarial(seed)
    frame = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(1) for c in ("th", "rn", "n", "node", "component")})
    assert found(jaccard.near_duplicates(frame)) == expected(docs)


def test_very_long_texts(spark):
    long = " ".join(f"w{i % 50_021}" for i in range(200_000))
    docs = [(1, long), (2, long + " more"), (3, "short")]
    assert found(jaccard.near_duplicates(spark.createDataFrame(docs, DOCS))) == expected(docs)
