"""Scan, reports, artefacts, enrichment, points."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.operators import artefacts as ar
from changeflow.operators import points as pt
from changeflow.operators import reports as rp
from changeflow.sources import documents as docs


def write(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(content if isinstance(content, bytes) else content.encode())


def test_scan(spark, tmp_path):
    write(tmp_path, "triage/a.md", "one\r\ntwo\rthree")
    write(tmp_path, "triage/ns/Al ert+é/b%20.md", "é")
    write(tmp_path, "triage/ns/c.txt", "no")
    write(tmp_path, "triage/.hidden/d.md", "no")
    write(tmp_path, "triage/bad.md", b"ab\xff")
    write(tmp_path, "conclusions/ns/e.md", "other family")
    found = docs.scan_texts(spark, str(tmp_path), ["triage/**/*.md", " triage/*.md"])
    got = {r["path"]: (r["content"], r["readable"]) for r in found.collect()}
    assert found.count() == 3
    assert got == {
        "triage/a.md": ("one\ntwo\nthree", True),
        "triage/ns/Al ert+é/b%20.md": ("é", True),
        "triage/bad.md": (None, False),
    }
    assert [r["path"] for r in docs.unreadable(found).collect()] == ["triage/bad.md"]


@pytest.mark.parametrize(
    "glob, yes, no",
    [
        ("triage/**/*.md", ["triage/x.md", "triage/a/b/x.md"], ["x/triage/x.md", "triage/x.mdx", "triage/.a/x.md", "triage/.x.md"]),
        ("*.md", ["x.md"], ["a/x.md", ".x.md"]),
        ("a?/x[1].md", ["ab/x[1].md"], ["a/x[1].md", "abc/x[1].md"]),
    ],
)
def test_globs(glob, yes, no):
    import re

    pattern = re.compile(docs.glob_pattern(glob))
    assert all(pattern.search(p) for p in yes) and not any(pattern.search(p) for p in no)


def frame(spark, rows, schema="path string, content string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def report(key, body="# b", **fields):
    lines = [f'{k}: "{v}"' for k, v in fields.items()]
    return "\n".join(["---", f'dedup_key: "{key}"', *lines, "---", body])


def test_report_keys_and_skips(spark):
    cases = {
        "own": "---\ndedup_key: k\nincident_key: i\n---\nb",
        "fallback": '---\ndedup_key: ""\nincident_key: i\n---\nb',
        "empty list": "---\ndedup_key:\nincident_key: i\n---\nb",
        "none": "---\nnamespace: n\n---\nb",
        "list": "---\ndedup_key:\n- a\nincident_key: i\n---\nb",
        "both empty": '---\ndedup_key: ""\nincident_key: ""\n---\nb',
        "no body": "---\ndedup_key: k\n---\n \n",
        "unclosed": "---\ndedup_key: k\nb",
        "no matter": "b",
    }
    raw = frame(spark, list(cases.items()))
    good = {r["path"]: r["dedup_key"] for r in rp.reports(raw).collect()}
    bad = {r["path"]: r["skip_reason"] for r in rp.report_skips(raw).collect()}
    assert good == {"own": "k", "fallback": "i", "empty list": "i"}
    assert bad == {
        "none": rp.NO_KEY, "list": rp.KEY_NOT_TEXT, "both empty": rp.NO_KEY, "no body": rp.EMPTY_BODY,
        "unclosed": rp.EMPTY_BODY, "no matter": rp.NO_KEY,
    }


def conclusion(**fields):
    return "\n".join(["---", *[f"{k}: {v}" for k, v in fields.items()], "---", "", "## Rationale", "", "why", ""])


def test_conclusion_rules(spark):
    long = "x" * 301
    cases = {
        "ok": conclusion(dedup_key="a", outcome="diagnosed", verdict="v", confidence="high"),
        "limit": conclusion(dedup_key="b", outcome="diagnosed", verdict="x" * 300, confidence="low"),
        "no verdict": conclusion(dedup_key="c", outcome="diagnosed", confidence="medium"),
        "no confidence": conclusion(dedup_key="d", outcome="diagnosed", verdict="v"),
        "inconclusive": conclusion(dedup_key="e", outcome="inconclusive", reason="r", confidence="high"),
        "long verdict": conclusion(dedup_key="f", outcome="diagnosed", verdict=long, confidence="high"),
        "long reason": conclusion(dedup_key="g", outcome="inconclusive", reason=long),
        "alta": conclusion(dedup_key="h", outcome="diagnosed", verdict="v", confidence="alta"),
        "list verdict": conclusion(dedup_key="i", outcome="diagnosed", verdict="", confidence="high"),
        "maybe": conclusion(dedup_key="j", outcome="maybe"),
        "missing": conclusion(dedup_key="k"),
        "no key": conclusion(incident_key="l", outcome="inconclusive", reason="r"),
    }
    rows = {r["path"]: r for r in ar.read_conclusions(frame(spark, list(cases.items()))).collect()}
    problems = {p: r["skip_reason"] for p, r in rows.items() if r["skip_reason"]}
    assert problems == {
        "long verdict": "bad verdict", "list verdict": "bad verdict", "alta": "bad confidence",
        "long reason": "bad reason", "maybe": "unknown outcome", "missing": "unknown outcome", "no key": ar.NO_KEY,
    }
    assert rows["no verdict"]["verdict"] == "" and rows["no confidence"]["confidence"] == "low"
    assert rows["inconclusive"]["confidence"] is None and rows["inconclusive"]["verdict"] is None
    assert rows["ok"]["rationale"] == "why" and rows["ok"]["reason"] is None


def test_bad_artefact_never_hides_a_good_one(spark):
    rows = [
        ("p1", conclusion(dedup_key="a", outcome="diagnosed", verdict="first", confidence="low")),
        ("p2", conclusion(dedup_key="a", outcome="diagnosed", verdict="second", confidence="high")),
        ("p3", conclusion(dedup_key="a", outcome="maybe")),
    ]
    (got,) = ar.conclusions(frame(spark, rows)).collect()
    assert tuple(got) == ("a", "diagnosed", "second", "high")
    human = [
        ("q1", "---\ndedup_key: a\nconfirmation: refuted\nnote: n\n---\n"),
        ("q2", "---\ndedup_key: a\nconfirmation: maybe\n---\n"),
        ("q3", "---\nconfirmation: confirmed\n---\n"),
    ]
    (got,) = ar.confirmations(frame(spark, human)).collect()
    assert got.asDict() == {"dedup_key": "a", "confirmation": "refuted"}


fields = st.text(alphabet=st.sampled_from('abc:"\\ntr\n\t\r -#é'), max_size=30)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(fields, fields, st.sampled_from([*ar.CONFIDENCE, None])), min_size=20, max_size=30))
def test_conclusion_round_trip(spark, cases):
    rows = [
        (
            f"k{i}",
            "diagnosed" if level else "inconclusive",
            finding if level else None,
            level,
            None if level else finding,
            # The rationale is prose; other kinds of line break read as a line feed.
            why.replace("\r", "").strip(),
        )
        for i, (finding, why, level) in enumerate(cases)
    ]
    names = ["dedup_key", "outcome", "verdict", "confidence", "reason", "rationale"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    back = ar.read_conclusions(df.select(F.col("dedup_key").alias("path"), ar.conclusion_markdown(df).alias("content")))
    got = sorted(map(tuple, back.filter("skip_reason is null").select(*names).collect()))
    # A rationale that itself starts with the heading loses that as well.
    assert got == sorted(rows)


def test_conclusion_text(spark):
    df = spark.createDataFrame(
        [("k", "diagnosed", 'a "b": c\\d', "high", None, " because ")],
        "dedup_key string, outcome string, verdict string, confidence string, reason string, rationale string",
    )
    assert df.select(ar.conclusion_markdown(df)).first()[0] == (
        '---\nschema: 1\ndedup_key: "k"\noutcome: diagnosed\nverdict: "a \\"b\\": c\\\\d"\nconfidence: high\n'
        "---\n\n## Rationale\n\nbecause\n"
    )


def test_conclusion_path(spark):
    paths = ["triage/data/Alert/2026__abc.md", "other/x.md", "triagem/x.md"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(ar.conclusion_path(F.col("p"))).collect()]
    assert got == ["conclusions/data/Alert/2026__abc.md", None, None]
    with pytest.raises(Exception, match="outside triage"):
        df.select(ar.checked_conclusion_path(F.col("p"))).collect()


def corpus(spark):
    reports = frame(
        spark,
        [
            ("triage/1.md", report("aaa", namespace="data", confirmation="confirmed")),
            ("triage/2.md", report("bbb")),
            ("triage/3.md", report("ccc", incident_key="inc", fired_at="t1", triaged_at="t2") ),
            ("triage/4.md", "---\ndedup_key: ddd\nalertnames:\n- A\n- B\n---\n# b"),
        ],
    )
    conclusions = spark.createDataFrame(
        [("aaa", "diagnosed", "v", "high"), ("bbb", "inconclusive", None, None), ("zzz", "diagnosed", "w", "low")],
        "dedup_key string, outcome string, verdict string, confidence string",
    )
    confirmations = spark.createDataFrame([("bbb", "refuted"), ("yyy", "confirmed")], "dedup_key string, confirmation string")
    return rp.reports(reports), conclusions, confirmations


def test_enrichment(spark):
    reports, conclusions, confirmations = corpus(spark)
    rows = pt.enrich(reports, conclusions, confirmations, "run1").collect()
    got = {r["dedup_key"]: r["metadata"].asDict() for r in rows}
    assert len(rows) == 4
    assert got["aaa"] == {
        "dedup_key": "aaa", "incident_key": "aaa", "namespace": "data", "alertnames": [], "fired_at": "",
        "triaged_at": "", "confirmation": "unverified", "run_id": "run1", "outcome": "diagnosed", "verdict": "v",
        "confidence": "high",
    }
    assert (got["bbb"]["outcome"], got["bbb"]["confidence"], got["bbb"]["confirmation"]) == ("inconclusive", None, "refuted")
    assert (got["ccc"]["outcome"], got["ccc"]["incident_key"], got["ccc"]["triaged_at"]) == (None, "inc", "t2")
    assert got["ddd"]["alertnames"] == ["A", "B"]


def test_coverage_and_orphans(spark):
    reports, conclusions, confirmations = corpus(spark)

    def stats(r, c, f):
        rows = pt.enrichment_stats(r, {"conclusion": c, "confirmation": f}).collect()
        return {x["kind"]: tuple(x)[1:] for x in rows}

    assert stats(reports, conclusions, confirmations) == {
        "conclusion": (3, 2, 4, 1, False), "confirmation": (2, 1, 4, 1, False),
    }
    assert stats(reports, conclusions.limit(0), confirmations.limit(0)) == {
        "conclusion": (0, 0, 4, 0, True), "confirmation": (0, 0, 4, 0, False),
    }
    assert stats(reports.limit(0), conclusions, confirmations) == {}
    lost = pt.orphans(reports, {"conclusion": conclusions, "confirmation": confirmations}).collect()
    assert sorted(map(tuple, lost)) == [("conclusion", "zzz"), ("confirmation", "yyy")]


def test_hot_key_is_split(spark):
    """A key in a third of the rows does not stay in one task of the join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500))
        left = spark.range(0, 60_000, 1, 8).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("t"))
        right = spark.range(0, 1000).select(F.concat(F.lit("k"), F.col("id") % 400).alias("k"), "id")
        right = right.groupBy("k").agg(F.max("id").alias("v")).unionByName(spark.sql("select 'hot' as k, 7L as v"))
        joined = pt.attach(left, right.groupBy("k").agg(F.max("v").alias("v")), "k")
        rows = joined.select("id", "v").toPandas()
        assert len(rows) == 60_000 and (rows["v"][rows["id"] % 3 == 0] == 7).all()
        assert "skew=true" in joined.select("id", "v", "t")._jdf.queryExecution().executedPlan().toString() or _skewed(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _skewed(df):
    df = df.select("*")
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_points(spark):
    import uuid

    body = "## Sintoma\ns\n## Causa\nx\n## Evidência\ne"
    reports = rp.reports(frame(spark, [("triage/1.md", report("k1", body)), ("triage/2.md", report("k2", "plain"))]))
    none = spark.createDataFrame([], "dedup_key string, outcome string, verdict string, confidence string, confirmation string")
    enriched = pt.enrich(reports, none, none, "r")
    sections = {(r["dedup_key"], r["metadata"]["section"]): r for r in pt.points_sections(enriched).collect()}
    assert set(sections) == {("k1", "symptom"), ("k1", "evidence")}
    assert sections[("k1", "symptom")]["point_id"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "k1#symptom"))
    whole = {r["dedup_key"]: r for r in pt.points_whole(enriched).collect()}
    assert whole["k1"]["text"] == body and whole["k1"]["metadata"]["section"] is None
    assert whole["k2"]["point_id"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "k2"))


def test_chunk_points(spark):
    import uuid

    df = spark.createDataFrame([("d/x.md", "a\n\nb" + "\n\n" + "c" * 1200), ("d/y.md", " \n\n ")], "path string, text string")
    rows = pt.chunk_points(pt.chunk_rows(df), "r").orderBy("metadata.chunk").collect()
    assert [(r["metadata"]["path"], r["metadata"]["chunk"], len(r["text"])) for r in rows] == [
        ("d/x.md", 0, 4), ("d/x.md", 1, 1000), ("d/x.md", 2, 350),
    ]
    assert rows[1]["point_id"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "d/x.md#1"))


def test_texts_are_written_by_many_tasks_one_file_each(spark, tmp_path, monkeypatch):
    """Before, the one task of a small table made a folder for every text."""
    monkeypatch.setattr(docs, "FILES_A_TASK", 3)
    rows = [(f"Alert/{i}+ä %.md", f"text {i}") for i in range(10)] + [("twice", "a"), ("twice", "b"), (None, None)]
    docs.write_texts(spark.createDataFrame(rows, "name string, value string").coalesce(1), f"{tmp_path}/out", "name", "value")
    assert len(list((tmp_path / "out").iterdir())) == 5
    found = docs.scan_texts(spark, str(tmp_path), ["out/**/*.txt"])
    name = F.url_decode(F.regexp_extract("path", r"/name=([^/]*)\.txt$", 1))
    got = sorted((r["n"], r["content"]) for r in found.select(name.alias("n"), "content").collect())
    want = [(n, f"{v}\n") for n, v in rows[:10]] + [("twice", "a\nb\n"), (docs.NO_NAME, "\n")]
    assert got == sorted(want)


def test_small_files_are_read_many_a_task(spark, tmp_path):
    """Before, a file counted for 4 MB more than it has, so a task had 4 of these, and the driver held them all."""
    for i in range(400):
        write(tmp_path, f"triage/{'all' if i < 300 else i}/{i}.md", f"text {i}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        found = docs.scan_texts(spark, str(tmp_path), ["triage/**/*.md"])
        assert found.rdd.getNumPartitions() == 4  # the cores: each may read 1000 such files
        assert found.inputFiles() == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(f"triage/{'all' if i < 300 else i}/{i}.md", f"text {i}") for i in range(400)]
    assert sorted((r["path"], r["content"]) for r in found.collect()) == sorted(want)


def test_pieces_hold_every_file_once():
    small = [(f"{i:04d}", 10) for i in range(2 * docs.FILES_A_PIECE + 1)]
    assert [len(p) for p in docs._pieces(small)] == [docs.FILES_A_PIECE, docs.FILES_A_PIECE, 1]
    large = [("a", docs.BYTES_A_PIECE * 3), ("b", 1), ("c", docs.BYTES_A_PIECE), ("d", 0)]
    assert list(docs._pieces(large)) == [["a"], ["b"], ["c", "d"]]
    assert list(docs._pieces([])) == []


def test_both_readers_find_the_same_files(spark, tmp_path):
    for name in (".a", "_a", "_a=b", "_metadata", "_metadata_x", "_common_metadata", "a._COPYING_", "é ü%20+", "A", "a b"):
        write(tmp_path, f"triage/{name}.md", name)
        write(tmp_path, f"triage/{name}/deep/x.md", name)
    write(tmp_path, "triage/x.md._COPYING_", "no")
    write(tmp_path, "triage/empty.md", "")
    write(tmp_path, "triage/none/x.txt", "no")
    write(tmp_path, "linked/y.md", "y")
    write(tmp_path, "triage/large.md", "x" * ((docs.BYTES_A_PIECE + 1)))
    (tmp_path / "triage/link").symlink_to(tmp_path / "linked")
    base = docs.qualified(spark, str(tmp_path))
    for globs in (["triage/**/*.md"], ["**/*"], ["triage/*.md", "linked/?.md"], ["triage/**/*.md", "triage/**/*.txt"], ["triage/none/*.md"]):
        folders = [f"{base}/{f}".rstrip("/") for f in docs._folders(globs)]
        one, other = (
            sorted((r["path"], bytes(r["content"])) for r in read(spark, base, folders, globs).collect())
            for read in (docs._read_by_tasks, docs._read_by_spark)
        )
        assert one == other
        assert bool(one) == (globs != ["triage/none/*.md"])


def test_package_imports_without_a_session():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
