"""Hard negatives against brute force over all pairs, and the certainty of the intervals."""

from __future__ import annotations

import math
import random

import numpy as np
import oracle
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeflow.llm import negatives as ng
from changeflow.llm import sql
from changeflow.llm.queries import QUERIES

DDL = "vec_id long, label int, embedding array<float>"


def brute(rows, anchors):
    def usable(r):
        whole = r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])
        return r[0] is not None and r[1] is not None and whole

    def ints(v):
        return [max(-ng.LIMIT, min(ng.LIMIT, math.floor(256 * float(np.float32(x))))) for x in v]

    rows = [(i, y, ints(v)) for i, y, v in filter(usable, rows)]
    anchors = {(i, y, tuple(ints(v))) for i, y, v in filter(usable, anchors)}
    out = []
    for i, y, v in anchors:
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in rows if j != i and len(w) == len(v)]
        scored.sort()
        for ps, p in [(-s, j) for s, j, z in scored if z == y][:5]:
            fit = [(-s, j) for s, j, z in scored if z != y and 80 * ps <= -100 * s <= 100 * ps]
            out += [(i, p, k + 1, j, ps, s) for k, (s, j) in enumerate(fit[:5])]
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def vectors(rng, n, dim, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    for i in range(n):
        c = rng.choice(centres)
        yield i, rng.randrange(4), [x + rng.gauss(0, spread) for x in c]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = list(vectors(rng, 700, 10, 0.3))
    out += [(700 + i, y, v) for i, y, v in vectors(rng, 60, 70, 0.1)]  # two words a code
    same = [0.5] * 10
    out += [(800 + i, i % 3, same) for i in range(200)]  # ties
    out += [(1000 + i, 1, None) for i in range(3)] + [(1010, None, same), (None, 1, same), (1020, 1, [0.1, None])]
    out += [(1030, 1, [math.inf] * 10), (1031, 2, [math.nan] * 10), (1032, 2, []), (1033, 2, []), (1034, 3, [])]
    out += [(1040, 1, [0.0] * 10), (1041, 1, [3e38] + [0.0] * 9), (1042, 2, [3e38] + [0.0] * 9)]
    return out + out[:5]


def test_negatives_agree_with_all_pairs(spark, rows, monkeypatch):
    frame = spark.createDataFrame(rows, DDL).repartition(5)
    anchors = [r for r in rows if r[0] is not None and r[0] % 9 == 0 or r[0] in (1032, 1041)]
    expected = brute(rows, anchors)
    assert len(expected) > 200
    assert found(ng.mine(frame, spark.createDataFrame(anchors, DDL))) == expected
    monkeypatch.setattr(ng, "SPREAD", 50)
    monkeypatch.setattr(ng, "ANCHOR_BLOCK", 20)
    extra = frame.withColumns({c: F.lit(1) for c in ("key", "block", "split", "score", "rank", "dim", "positives")})
    assert found(ng.mine(extra, spark.createDataFrame(anchors, DDL))) == expected


def test_query_agrees_with_sql(spark):
    sf = "/root/testdata/sf0.1"
    name = "op11_hard_negative_mining"
    assert oracle.difference(spark, oracle.connect(sf), QUERIES[name], sql.ORACLES[name], sf) is None


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], DDL)
    assert ng.mine(nothing, nothing).collect() == []
    assert ng.mine(spark.createDataFrame([(1, 1, [0.5])], DDL), nothing).collect() == []


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_every_score_lies_in_its_interval(spark, dim):
    rng = random.Random(dim)
    rows = list(vectors(rng, 300, dim, 0.5)) + [(400, 1, [0.0] * dim)]
    side = ng.Side(pa.Table.from_pandas(ng.codes(spark.createDataFrame(rows, DDL)).toPandas()), dim)
    low, high = ng.Planes(side, 0, 50).intervals(side, 0, side.n)
    exact = side.ints[:50].astype(np.int64) @ side.ints.astype(np.int64).T
    assert (low <= exact).all() and (exact <= high).all()
