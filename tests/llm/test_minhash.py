"""One-permutation MinHash and its near duplicates against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import minhash as mh
from changeflow.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def shingle_set(text, size=2):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(docs, numerator=80, size=2):
    """`[(doc_id, n_shingles, component_id, kept)]` by comparing all distinct sets that share a shingle."""
    sets = [shingle_set(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by_set = {}
    for i, s in enumerate(sets):
        if s:
            root[find(i)] = find(by_set.setdefault(s, i))
    kept = list(by_set.items())
    ids = {}
    for s, _ in kept:
        for t in s:
            ids.setdefault(t, len(ids))
    rows = [np.fromiter((ids[t] for t in s), np.int64) for s, _ in kept]
    lists = {}
    for k, r in enumerate(rows):
        for t in r:
            lists.setdefault(t, []).append(k)
    for k, r in enumerate(rows):
        shared = np.zeros(k + 1, np.int64)
        for t in r:
            earlier = lists[t]
            shared[[j for j in earlier if j <= k]] += 1
        sizes = np.array([len(x) for x in rows[: k + 1]])
        for j in np.flatnonzero(100 * shared >= numerator * (sizes + len(r) - shared)):
            root[find(kept[j][1])] = find(kept[k][1])
    names = {}
    for i, (d, _) in enumerate(docs):
        c = find(i)
        if d is not None and (names.get(c) is None or d < names[c]):
            names[c] = d
    out = []
    for i, (d, _) in enumerate(docs):
        name = names.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), name, d == name))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_bins_agree_as_often_as_the_sets_are_similar():
    rng, order = np.random.default_rng(1), mh.borrowing_order()
    for shared, own in ((1, 0), (4, 1), (40, 10), (400, 100), (4000, 1000)):
        agree = []
        for _ in range(40):
            core = rng.integers(0, 1 << 63, shared, np.uint64) * np.uint64(2)
            a = np.unique(np.append(core, rng.integers(0, 1 << 63, own, np.uint64) * np.uint64(2)))
            b = np.unique(np.append(core, rng.integers(0, 1 << 63, own, np.uint64) * np.uint64(2)))
            agree.append(np.mean(mh.signature(a, order) == mh.signature(b, order)))
        assert np.mean(agree) == pytest.approx(shared / (shared + 2 * own), abs=0.07)


def test_borrowed_values_come_from_the_first_bin_asked():
    order = mh.borrowing_order()
    tokens = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 5, np.uint64) * np.uint64(2))
    bins = (tokens >> np.uint64(64 - mh.BIN_BITS)).astype(int)
    got = mh.signature(tokens, order)
    for i in range(mh.BINS):
        asked = min(set(bins.tolist()), key=lambda j: (i != j, order[i, j], j))
        assert got[i] == min(t for t, b in zip(tokens, bins) if b == asked)


def mutated(rng, words, share):
    return [w if rng.random() > share else f"n{rng.randrange(10**6)}" for w in words]


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for base in range(25):
        words = rng.choices(vocabulary, k=rng.choice([3, 9, 30, 120, 400]))
        for _ in range(12):
            out.append(" ".join(mutated(rng, words, rng.choice([0, 0.02, 0.05, 0.1, 0.14]))))
    # A template whose instances share much but not enough, and two that meet only through a third.
    template = rng.choices(vocabulary, k=60)
    out += [" ".join(template + [f"own{i}x{j}" for j in range(12)]) for i in range(40)]
    core = [f"c{i}" for i in range(100)]
    out += [" ".join(core), " ".join(core[:90]), " ".join(core[10:])]
    out += ["", " ", "one", "One", "two words", "TWO  words", "one", None, None]
    docs = [(i * 3 % 1009, t) for i, t in enumerate(out)]
    return docs + [(None, "two words"), (None, "nothing like it"), (7, out[0]), (7, out[0])]


def test_components_agree_with_all_pairs(spark, documents):
    frame = spark.createDataFrame(documents, DOCS).repartition(4)
    assert found(mh.near_duplicates(frame)) == brute(documents)


def test_query_agrees_on_the_given_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op13_minhash_near_dedup"](spark, "/root/testdata/sf0.01")) == brute(docs)


def test_links_that_no_star_meets_are_found_pair_by_pair(spark, documents, monkeypatch):
    monkeypatch.setattr(mh, "STARS", 0)
    assert found(mh.near_duplicates(spark.createDataFrame(documents, DOCS))) == brute(documents)


def test_empty_tables_clashing_columns_and_long_texts(spark):
    assert mh.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    long = " ".join(f"w{i % 70_001}" for i in range(300_000))
    docs = [(1, long), (2, long + " more"), (3, "short")]
    frame = spark.createDataFrame(docs, DOCS).withColumns(
        {c: F.lit(3) for c in ("th", "node", "n", "bucket", "component", "least", "k")}
    )
    assert found(mh.near_duplicates(frame)) == brute(docs)
