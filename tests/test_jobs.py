"""The jobs end to end, over files on disk."""

import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from changeflow.functions.vectors import with_vectors
from changeflow.operators import artefacts as ar
from changeflow.operators import classify as cl
from changeflow.operators import costs
from changeflow.operators import index as ix
from changeflow.operators import points as pt
from changeflow.operators import reports as rp
from changeflow.plans import jobs
from changeflow.session import work_dir
from changeflow.sources import documents as docs

NOW = datetime(2026, 7, 8, 3, 0, 0, tzinfo=timezone.utc)
BODY = "## Sintoma\npod caiu\n\n## Causa provável\n{}\n\n## Confiança\nAlta."


def put(root, path, text):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text, encoding="utf-8")


def report(key, body):
    return f'---\ndedup_key: "{key}"\nalertnames:\n  - "Down"\nnamespace: "data"\n---\n\nPreamble\n\n{body}\n'


@pytest.fixture
def root(tmp_path):
    for key, cause in (("aaa", "disco cheio"), ("bbb", "rede"), ("ccc", "quota")):
        put(tmp_path, f"triage/data/Down/2026__{key}.md", report(key, BODY.format(cause)))
    put(tmp_path, "triage/data/Down/none.md", "no key")
    put(tmp_path, "conclusions/data/Down/2026__aaa.md", "malformed")
    put(tmp_path, "confirmations/x/2026__bbb.md", "---\ndedup_key: bbb\nconfirmation: confirmed\n---\n")
    return tmp_path


def test_classify_then_index(spark, root, tmp_path):
    reports = rp.reports(jobs.texts(spark, str(root), docs.REPORT_GLOBS))
    existing = jobs.texts(spark, str(root), docs.CONCLUSION_GLOBS)
    out = work_dir(spark, "classify")
    # The malformed conclusion of aaa counts as present.
    assert jobs.classify(reports, existing, out) == {"done": 2, "skipped": 1, "failed": 0}
    first = spark.read.parquet(f"{out}/conclusions")
    again = work_dir(spark, "classify")
    assert jobs.classify(reports, first, again) == {"done": 0, "skipped": 3, "failed": 0}
    scoped = work_dir(spark, "classify")
    assert jobs.classify(reports, first, scoped, cl.Scope(dedup_key="aaa")) == {"done": 1, "skipped": 2, "failed": 0}
    with pytest.raises(RuntimeError, match="no report matches"):
        jobs.classify(reports, first, work_dir(spark, "classify"), cl.Scope(dedup_key="zzz"))

    # The artefacts, written as files, are what the index job reads.
    for row in spark.read.parquet(f"{scoped}/conclusions").collect():
        put(root, row["path"], row["content"])
    index = ix.PointIndex(spark, work_dir(spark, "sections"))
    assert jobs.index_reports(spark, str(root), index, NOW, pt.points_sections) == {"points_in": 6, "points": 6}
    rows = {(r["dedup_key"], r["suffix"]): r["metadata"] for r in index.read().collect()}
    cause = rows[("bbb", "cause")]
    assert (cause["outcome"], cause["verdict"], cause["confidence"]) == ("diagnosed", "rede", "high")
    assert cause["confirmation"] == "confirmed" and rows[("aaa", "cause")]["confirmation"] == "unverified"
    assert cause["run_id"] == "20260708T030000Z" and cause["section"] == "cause"

    # A report that disappears takes its points with it.
    (root / "triage/data/Down/2026__ccc.md").unlink()
    assert jobs.index_reports(spark, str(root), index, NOW + timedelta(hours=1), pt.points_sections)["points"] == 4
    whole = ix.PointIndex(spark, work_dir(spark, "whole"))
    assert jobs.index_reports(spark, str(root), whole, NOW)["points"] == 2
    query = spark.createDataFrame([("q",)], "query_id string").withColumn("text", F.lit(BODY.format("disco cheio")))
    queries = with_vectors(query)
    best = ix.cosine_topk(whole.read(), queries, 1, point="point_id", vector="vector").first()
    assert best["sim"] > 0.99 and best["point_id"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "aaa"))


def test_copies_of_a_key_make_one_point(spark, root):
    put(root, "triage/zz/later.md", report("aaa", BODY.format("outra causa")))
    index = ix.PointIndex(spark, work_dir(spark, "whole"))
    assert jobs.index_reports(spark, str(root), index, NOW) == {"points_in": 4, "points": 3}
    (row,) = index.read().filter("dedup_key = 'aaa'").collect()
    assert row["path"] == "triage/zz/later.md"


def test_index_chunks(spark, root):
    index = ix.PointIndex(spark, work_dir(spark, "chunks"))
    docs_root = root / "docs"
    put(docs_root, "a/long.md", "p" * 2000 + "\n\nshort")
    put(docs_root, "b.md", "one\n\ntwo")
    put(docs_root, "skip.txt", "no")
    (docs_root / "bad.md").write_bytes(b"\xff\xfe")
    assert jobs.index_chunks(spark, str(docs_root), index, NOW)["points"] == 5
    (docs_root / "a/long.md").unlink()
    assert jobs.index_chunks(spark, str(docs_root), index, NOW + timedelta(hours=1))["points"] == 1
    with pytest.raises(ix.EmptySource):
        jobs.index_chunks(spark, str(root / "nothing"), index, NOW + timedelta(hours=2))
    with pytest.raises(ix.EmptySource):
        jobs.index_chunks(spark, str(root / "nothing"), ix.PointIndex(spark, work_dir(spark, "new")), NOW)


def test_failing_scorer_fails_the_job(spark, root):
    def factory():
        def ask(_):
            raise OSError("gateway")

        return ask

    reports = rp.reports(jobs.texts(spark, str(root), docs.REPORT_GLOBS))
    existing = jobs.texts(spark, str(root), docs.CONCLUSION_GLOBS)
    with pytest.raises(RuntimeError, match="all 3 reports failed"):
        jobs.classify(reports, existing, work_dir(spark, "c"), cl.ALL, cl.batch_scorer(factory))


def test_result_attributes(spark, root):
    reports = rp.reports(jobs.texts(spark, str(root), docs.REPORT_GLOBS))
    rows = jobs.call_attributes(reports, cl.score(reports), costs.trace_attributes("r1")).collect()
    got = {r["dedup_key"]: r["attributes"] for r in rows}
    assert got["aaa"]["incident.outcome"] == ar.DIAGNOSED and got["aaa"]["incident.confidence"] == "high"
    assert got["aaa"]["trace.trace.name"] == "classify:Down"


def test_call_attributes_meet_by_path(spark):
    rows = [(f"triage/{i}.md", "---\ndedup_key: same\nnamespace: n\n---\n## Causa\nx") for i in range(20)]
    reports = rp.reports(spark.createDataFrame(rows, "path string, content string"))
    assert jobs.call_attributes(reports, cl.score(reports), costs.trace_attributes("r1")).count() == 20


def test_small_files_of_all_families_are_read_many_a_task(spark, tmp_path):
    """Before, tasks grew with the files, four or fewer a task where partitions are of 16 MB."""
    for i in range(100):
        for family, field in (("triage", "namespace: n"), ("conclusions", "outcome: inconclusive\nreason: r"), ("confirmations", "confirmation: refuted")):
            target = tmp_path / family / "ns" / f"{i}.md"
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(f"---\r\ndedup_key: k{i}\n{field}\n---\n# body\n".encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        for globs in (docs.REPORT_GLOBS, docs.CONCLUSION_GLOBS, docs.CONFIRMATION_GLOBS):
            assert jobs.texts(spark, str(tmp_path), globs).rdd.getNumPartitions() <= 4
        rows = jobs.enriched_reports(spark, str(tmp_path), "run").select("dedup_key", "body", "metadata.outcome", "metadata.confirmation").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, rows)) == sorted((f"k{i}", "# body", "inconclusive", "refuted") for i in range(100))
