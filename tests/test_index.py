"""Vectors, index, search, classification, costs."""

import os
import sys
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.functions import vectors
from changeflow.functions.vectors import with_vectors
from changeflow.operators import artefacts as ar
from changeflow.operators import classify as cl
from changeflow.operators import costs
from changeflow.operators import index as ix
from changeflow.operators import reports as rp
from changeflow.plans import queries
from changeflow.session import work_dir

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_hashed_vectors(spark):
    texts = ["a b  b", "", "B a b", "  ", "c" * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(2)
    got = [np.array(r["vector"]) for r in with_vectors(df).orderBy("i").collect()]
    assert all(v.shape == (64,) for v in got)
    assert np.allclose(got[0], got[2])
    assert [round(float(np.linalg.norm(v)), 5) for v in got] == [1, 0, 1, 0, 1]


def test_embedding_hook_loads_once_per_task(spark):
    def factory():
        calls = []

        def embed(texts):
            calls.append(len(texts))
            return np.array([[len(t), len(calls), max(calls)] for t in texts], float)

        return embed

    df = spark.createDataFrame([("x" * i,) for i in range(20)], "text string").coalesce(1)
    got = [r["vector"] for r in with_vectors(df, factory, batch=8).collect()]
    assert [v[0] for v in got] == list(range(20))
    assert [v[1] for v in got] == [1] * 8 + [2] * 8 + [3] * 4 and max(v[2] for v in got) == 8


def brute(points, queries, k, same_label):
    out = set()
    for qid, q, wanted in queries:
        sims = []
        for pid, p, label in points:
            if same_label and label != wanted:
                continue
            norm = np.linalg.norm(p) * np.linalg.norm(q)
            sims.append((-round(float(np.dot(p, q) / norm), 9) if norm else 0.0, pid))
        out |= {(qid, rank + 1, pid) for rank, (_, pid) in enumerate(sorted(sims)[:k])}
    return out


@pytest.mark.parametrize("field", [None, "label"])
@pytest.mark.parametrize("small", [False, True])
def test_search_is_exact(spark, monkeypatch, field, small):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 8)).round(3)
    vectors[::3] = vectors[0]  # a third of the points are copies of one
    vectors[1] = 0
    points = [(i, v.tolist(), i % 4) for i, v in enumerate(vectors)]
    queries = [(100 + i, v.tolist(), i % 5) for i, v in enumerate(rng.normal(size=(7, 8)).round(3))] + [(99, vectors[0].tolist(), 0)]
    if small:
        monkeypatch.setattr(ix, "QUERY_BYTES", 150)
        monkeypatch.setattr(ix, "TILE", 8)
    p = spark.createDataFrame(points, "vec_id bigint, embedding array<float>, label int").repartition(5)
    q = spark.createDataFrame(queries, "query_id bigint, vector array<double>, wanted int")
    p32 = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab in points]
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in ix.cosine_topk(p, q, 6, field=field).collect()}
    assert got == brute(p32, queries, 6, field is not None)


def test_many_queries_are_more_groups_not_more_plan(spark, monkeypatch):
    rng = np.random.default_rng(4)
    p, q = rng.standard_normal((300, 8)), rng.standard_normal((10_000, 8))
    monkeypatch.setattr(ix, "QUERY_BYTES", 100_000)
    pf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(p)], "vec_id long, embedding array<double>")
    qf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id long, vector array<double>")
    out = ix.cosine_topk(pf, qf, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "Union" not in plan
    sims = (q / np.linalg.norm(q, axis=1)[:, None]) @ (p / np.linalg.norm(p, axis=1)[:, None]).T
    expected = {(i, r + 1, int(j)) for i, row in enumerate(np.argsort(-sims, axis=1)[:, :3]) for r, j in enumerate(row)}
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in out.collect()} == expected


def test_search_by_text_ids(spark):
    p = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0]), ("d", None)], "point_id string, vector array<float>")
    q = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, vector array<float>")
    got = ix.cosine_topk(p, q, 2, point="point_id", vector="vector").orderBy("rank").collect()
    assert [(r["point_id"], round(r["sim"], 6)) for r in got] == [("a", 1.0), ("b", 1.0)]


def points(spark, rows, run):
    df = spark.createDataFrame([(i, p, x) for i, p, x in rows], "point_id string, path string, text string")
    return df.withColumn("run_id", F.lit(run)).withColumn("vector", F.array(F.lit(1.0).cast("float")))


def test_refresh_replaces_and_collects(spark):
    index = ix.PointIndex(spark, work_dir(spark, "ix"), dim=1)
    assert index.read() is None
    first = index.refresh(points(spark, [("1", "a", "x"), ("2", "a", "y")], "r1"), "r1", T0)
    assert first == {"points_in": 2, "points": 2}
    rows = [("2", "a", "new"), ("3", "a", "z"), ("3", "b", "greatest path"), ("3", "a", "z")]
    again = points(spark, rows, "r2")
    assert index.refresh(again, "r2", T0 + timedelta(hours=1)) == {"points_in": 4, "points": 2}
    assert {(r["point_id"], r["text"], r["run_id"]) for r in index.read().collect()} == {
        ("2", "new", "r2"), ("3", "greatest path", "r2"),
    }
    assert index.refresh(again, "r2", T0 + timedelta(hours=2))["points"] == 2  # same rows again


def test_upsert_then_garbage_equals_refresh(spark):
    old = points(spark, [("1", "a", "x"), ("2", "a", "y")], "r1")
    new = points(spark, [("2", "a", "n"), ("3", "b", "z")], "r2")
    merged = ix.upsert(old, new)
    assert {(r["point_id"], r["text"]) for r in merged.collect()} == {("1", "x"), ("2", "n"), ("3", "z")}
    kept = ix.collect_garbage(merged.unionByName(old.limit(1).withColumn("run_id", F.lit(None).cast("string"))), "r2")
    assert kept.exceptAll(ix.reconcile(new)).isEmpty() and ix.reconcile(new).exceptAll(kept).isEmpty()


def test_empty_source_leaves_the_index_alone(spark):
    index = ix.PointIndex(spark, work_dir(spark, "ix"), dim=1)
    none = points(spark, [("1", "a", "x")], "r").limit(0)
    with pytest.raises(ix.EmptySource):
        index.refresh(none, "r0", T0, allow_empty_first_run=False)
    assert index.refresh(none, "r0", T0) == {"points_in": 0, "points": 0}
    index.refresh(points(spark, [("1", "a", "x")], "r1"), "r1", T0 + timedelta(hours=1))
    with pytest.raises(ix.EmptySource):
        index.refresh(none, "r2", T0 + timedelta(hours=2))
    assert index.read().count() == 1
    # Another dimension: the collection is recreated, so an empty run is fine.
    other = ix.PointIndex(spark, index.root, dim=2)
    assert other.read() is None
    other.refresh(none, "r3", T0 + timedelta(hours=3))
    assert not index.compatible()


def test_point_filter(spark):
    df = spark.sql(
        """SELECT 1 AS id, named_struct('namespace', 'a', 'alertnames', array('X', 'Y'), 'outcome', 'diagnosed') AS metadata
        UNION ALL SELECT 2, named_struct('namespace', 'a', 'alertnames', array('Y'), 'outcome', cast(null AS string))
        UNION ALL SELECT 3, named_struct('namespace', 'b', 'alertnames', cast(null AS array<string>), 'outcome', 'diagnosed')"""
    )

    def ids(**fields):
        return [r["id"] for r in df.filter(ix.point_filter(**fields)).orderBy("id").collect()]

    assert ids() == [1, 2, 3] and ids(alertnames="X") == [1] and ids(alertnames="Y") == [1, 2]
    assert ids(namespace="a", outcome="diagnosed") == [1] and ids(outcome="diagnosed") == [1, 3]
    with pytest.raises(ValueError):
        ix.point_filter(run_id="x")


# -- classification --------------------------------------------------------


def reports(spark, bodies):
    rows = [(f"triage/{k}.md", f"---\ndedup_key: {k}\nnamespace: n{i % 2}\n---\n{b}") for i, (k, b) in enumerate(bodies.items())]
    return rp.reports(spark.createDataFrame(rows, "path string, content string").repartition(3))


def keys(df):
    return sorted(r["dedup_key"] for r in df.collect())


def test_selection(spark):
    all_reports = reports(spark, {"a": "# x", "b": "# x", "c": "# x"})
    # Only the file counts, malformed or not.
    existing = spark.createDataFrame([("conclusions/a.md", "garbage"), ("conclusions/zzz.md", "")], "path string, content string")
    assert keys(cl.select_reports(all_reports, existing)) == ["b", "c"]
    assert keys(cl.select_reports(all_reports, existing, cl.ALL)) == ["a", "b", "c"]
    assert keys(cl.select_reports(all_reports, existing, cl.Scope(dedup_key="a"))) == ["a"]
    assert keys(cl.select_reports(all_reports, existing, cl.Scope(namespace="n0"))) == ["a", "c"]


def test_rule_scorer(spark):
    cause = "## Causa provável\n{}\n\nmore\n## Confiança\n\n{}"
    bodies = {
        "high": cause.format("disco cheio", "**Alta**. Certo"),
        "medium": cause.format("x", "média"),
        "low": cause.format("x", "Baixa."),
        "other": cause.format("x", "talvez"),
        "silent": "## Causa provavel\nx",
        "long": cause.format("y" * 400, "alta"),
        "none": "## Sintoma\ns",
    }
    got = {r["dedup_key"]: r for r in cl.score(reports(spark, bodies)).collect()}
    assert {k: r["confidence"] for k, r in got.items()} == {
        "high": "high", "medium": "medium", "low": "low", "other": "low", "silent": "low", "long": "high", "none": None,
    }
    assert got["high"]["verdict"] == "disco cheio\n\nmore" and got["long"]["verdict"] == "y" * 400 + "\n\nmore"
    assert got["none"]["outcome"] == ar.INCONCLUSIVE and got["none"]["reason"]
    assert {k for k, r in got.items() if r["error"]} == {"long"}  # too long is an error, not a cut
    assert all(r["path"] == f"conclusions/{k}.md" for k, r in got.items())


def test_batch_scorer_retries_and_isolates_failures(spark):
    def factory():
        seen = {}

        def ask(bodies):
            out = []
            for b in bodies:
                seen[b] = seen.get(b, 0) + 1
                if b == "# boom":
                    raise RuntimeError("down")
                good = {"outcome": "diagnosed", "verdict": f"try {seen[b]}", "confidence": "low", "rationale": "r"}
                bad = {**good, "verdict": "x" * 301}
                out.append(bad if b == "# never" or (b == "# second" and seen[b] < 2) else good)
            return out

        return ask

    bodies = {"a": "# first", "b": "# second", "c": "# never", "d": "# boom"}
    scored = cl.score(reports(spark, bodies), cl.batch_scorer(factory, retries=2, batch=1))
    got = {r["dedup_key"]: r for r in scored.collect()}
    assert got["a"]["verdict"] == "try 1" and got["b"]["verdict"] == "try 2"
    assert got["c"]["error"] == "bad verdict" and got["c"]["verdict"] is None
    assert got["d"]["error"] == "call failed: down"
    counts = cl.summary(reports(spark, {**bodies, "e": "# x"}), scored).first()
    assert tuple(counts) == (2, 1, 2)
    existing = spark.createDataFrame([("conclusions/b.md", "old"), ("conclusions/c.md", "old"), ("conclusions/x.md", "keep")], "path string, content string")
    written = {r["path"]: r["content"] for r in cl.write_conclusions(existing, scored).collect()}
    assert set(written) == {f"conclusions/{k}.md" for k in "abcx"}
    assert 'verdict: "try 2"' in written["conclusions/b.md"] and written["conclusions/c.md"] == "old"


def test_failure_policy():
    cl.check_run(3, 2, 1, 1, cl.MISSING)
    cl.check_run(3, 0, 0, 0, cl.MISSING)
    for bad in ((0, 0, 0, 0, cl.MISSING), (3, 0, 0, 0, cl.Scope(dedup_key="x")), (3, 2, 0, 2, cl.MISSING)):
        with pytest.raises(RuntimeError):
            cl.check_run(*bad)


# -- costs -----------------------------------------------------------------


def test_trace_attributes(spark):
    rows = [
        ("1", "---\ndedup_key: k\nalertnames:\n- A\n- B\nnamespace: ai\n---\n# b"),
        ("2", "---\ndedup_key: m\n---\n# b"),
    ]
    df = rp.reports(spark.createDataFrame(rows, "path string, content string"))
    got = {r["dedup_key"]: r["a"] for r in df.select("dedup_key", costs.trace_attributes("r1").alias("a")).collect()}
    assert got["k"] == {
        "trace.session.id": "k", "trace.trace.name": "classify:A,B", "incident.alertname": "A,B",
        "incident.namespace": "ai", "incident.run_id": "r1",
    }
    assert got["m"]["trace.trace.name"] == "classify" and got["m"]["incident.alertname"] == ""
    mixed = F.map_concat(costs.trace_attributes("r1"), F.create_map(F.lit("user.email"), F.lit("x")))
    kept = {r["dedup_key"]: set(r["a"]) for r in df.select("dedup_key", costs.domain_attributes(mixed).alias("a")).collect()}
    assert kept["m"] == {"trace.session.id", "trace.trace.name", "incident.run_id"} and "user.email" not in kept["k"]


def test_call_cost(spark):
    cases = ["0.005534", None, "", "free", " 1e-3 "]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, raw string")
    got = [r["c"] for r in df.orderBy("i").select(costs.call_cost(F.col("raw")).alias("c")).collect()]
    assert got == [0.005534, None, None, None, 0.001]


def test_search_survives_broken_vectors(spark):
    inf = float("inf")
    clean = [(i, [1.0, i / 10.0]) for i in range(8)]
    broken = [(10, [inf, 1.0]), (11, [float("nan"), 1.0]), (12, [1.0, 0.0, 1.0]), (13, [0.0]), (14, [None, 1.0]), (15, [inf, inf])]
    p = spark.createDataFrame(clean + broken, "vec_id int, embedding array<float>").coalesce(1)
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, vector array<double>")
    assert [r["vec_id"] for r in ix.cosine_topk(p, q, 3).orderBy("rank").collect()] == [0, 1, 2]
    ragged = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "query_id bigint, vector array<double>")
    with pytest.raises(ValueError, match="numbers"):
        ix.cosine_topk(p, ragged, 3)


def test_index_keeps_its_dimension_and_one_folder(spark):
    root = work_dir(spark, "ix")
    index = ix.PointIndex(spark, root, dim=32)
    p = points(spark, [("1", "a b c", "x"), ("2", "d", "y")], "r1").drop("vector")
    index.refresh(p, "r1", T0)
    assert {len(r["vector"]) for r in index.read().collect()} == {32}
    index.refresh(p, "r2", T0 + timedelta(hours=1))
    folders = [f for f in os.listdir(f"{root}/points") if not f.startswith(".")]
    assert len(folders) == 1
    with pytest.raises(ix.EmptySource):
        index.refresh(p.limit(0), "r3", T0 + timedelta(hours=2))
    with pytest.raises(ValueError, match="32 numbers"):
        index.refresh(p.withColumn("vector", F.array(F.lit(1.0).cast("float"))), "r4", T0 + timedelta(hours=3))
    assert [f for f in os.listdir(f"{root}/points") if not f.startswith(".")] == folders
    assert index.read().count() == 2


def test_folders_stay_for_readers_and_no_orphan_stays(spark, monkeypatch):
    def folders():
        return {f for f in os.listdir(f"{root}/points") if not f.startswith(".")}

    root = work_dir(spark, "ix")
    index = ix.PointIndex(spark, root, dim=1, grace=timedelta(hours=1))
    index.refresh(points(spark, [("1", "a", "old")], "r1"), "r1", T0)
    open_before = index.read()
    new = points(spark, [("1", "a", "new"), ("2", "a", "y")], "r2")
    index.refresh(new, "r2", T0 + timedelta(hours=1))
    assert [r["text"] for r in open_before.collect()] == ["old"]  # read across a refresh
    assert index.read().count() == 2 and len(folders()) == 2

    before = folders()
    with monkeypatch.context() as m:
        m.setattr(ix, "append_row", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            index.refresh(new, "r3", T0 + timedelta(hours=1, minutes=30))
    (orphan,) = folders() - before
    index.refresh(new, "r4", T0 + timedelta(hours=2))  # r1 ended an hour ago, the orphan began half an hour ago
    assert len(folders()) == 3 and orphan in folders()
    index.refresh(new, "r5", T0 + timedelta(hours=3))
    assert len(folders()) == 2 and orphan not in folders()
    assert index.read().count() == 2


def test_an_empty_source_is_refused_before_embedding(spark):
    index = ix.PointIndex(spark, work_dir(spark, "ix"), dim=1)
    some = points(spark, [("1", "a", "x")], "r1")
    index.refresh(some, "r1", T0)

    def never():
        raise AssertionError("embedded")

    with pytest.raises(ix.EmptySource):
        index.refresh(some.drop("vector").filter("false"), "r2", T0 + timedelta(hours=1), embed=never)
    assert index.runs().count() == 1


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_hashed_words_are_those_of_the_buckets(spark):
    """Before, every word went through five JVM expressions; now a task hashes a word once."""
    texts = ["a B a", "", "\u00c9t\u00e9 \x0b\tx\u00a0y " + "w" * 100, "one two " * 700]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    out = vectors.with_vectors(df, dim=16)
    assert "md5" not in _plan(out)
    for row in out.withColumn("b", vectors.word_buckets(F.col("text"), 16)).collect():
        want = np.bincount(np.abs(row["b"]).astype(int), np.sign(row["b"]), 17)[1:]
        norm = np.linalg.norm(want) or 1
        assert row["vector"] == pytest.approx(want / norm, abs=1e-6)


def test_hooks_hold_a_slice_of_texts(spark):
    """Before, a task turned all texts of an Arrow batch into Python's, with their vectors."""
    df = spark.range(0, 3000, 1, 1).select(F.col("id").cast("string").alias("text"))

    def model():
        return lambda texts: [[len(sys._getframe(1).f_locals["values"]), int(t)] for t in texts]

    rows = vectors.with_vectors(df, model).collect()
    assert all(int(r["text"]) == r["vector"][1] for r in rows) and len(rows) == 3000
    assert max(r["vector"][0] for r in rows) <= vectors.SLICE

    def client():
        def ask(bodies):
            held = len(sys._getframe(1).f_locals["bodies"])
            return [{"outcome": "inconclusive", "reason": f"{held} {b}", "rationale": "r"} for b in bodies]

        return ask

    reports = df.select(F.col("text").alias("dedup_key"), F.concat(F.lit("triage/"), "text").alias("path"), F.col("text").alias("body"))
    told = cl.score(reports, cl.batch_scorer(client)).collect()
    assert len(told) == 3000 and all(r["reason"].split()[1] == r["dedup_key"] for r in told)
    assert max(int(r["reason"].split()[0]) for r in told) <= cl.SLICE


def test_the_client_of_the_query_keeps_no_bodies():
    ask = queries._client()
    with pytest.raises(OSError):
        ask(["ab"])
    ask(["ab"]), ask(["abc"])
    (asked,) = [c.cell_contents for c in ask.__closure__]
    assert [len(d) for d in asked] == [16]


def test_reports_are_parsed_once(spark, sf_dir, monkeypatch):
    """Before, both uses of the scores, and every use of the points, parsed all reports anew."""
    assert "regexp_extract_all" not in _plan(queries.conclusion_write(spark, sf_dir))
    seen, refresh = [], ix.PointIndex.refresh

    def spy(self, points, *args):
        seen.append(_plan(points))
        return refresh(self, points, *args)

    monkeypatch.setattr(ix.PointIndex, "refresh", spy)
    queries.run_metrics(spark, sf_dir)
    assert len(seen) == 2 and not any("regexp_extract_all" in p for p in seen)
