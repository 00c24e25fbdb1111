"""Merge, log, time travel, feed: against a dict that plays the table."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes as ch
from changeflow.operators import load as ld
from changeflow.operators import maintain as mt
from changeflow.operators import messages as ms
from changeflow.operators import migrate as mg
from changeflow.session import hadoop_path, path_exists, work_dir
from changeflow.sources.ledger import Ledger
from changeflow.streaming import feed

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(hours):
    return T0 + timedelta(hours=hours)


RAW = "seq bigint, account_id bigint, op string, status string, tier string, region string, balance double, updated_at timestamp"


def raw_ops(spark, seed, n=60, keys=25):
    rng = random.Random(seed)
    rows = [
        (
            i,
            0 if rng.random() < 0.3 else rng.randrange(keys),
            rng.choice(["insert", "update", "update", "delete"]),
            rng.choice(["active", "blocked", "closed"]),
            rng.choice(["bronze", "silver", "gold"]),
            rng.choice(["SP", "RJ", "MG", "BA"]),
            rng.randrange(10000) / 100,
            at(seed),
        )
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, RAW)


def model(state, rows):
    """Apply the last operation of each key. Returns the new state and change types."""
    last = {r[1]: r for r in rows}
    new, kinds = dict(state), []
    for key, (_, _, op, status, tier, region, balance, _) in last.items():
        if key in state and op == "delete":
            del new[key]
            kinds.append((key, "delete"))
        elif key in state and op == "update":
            _, t, r, _, v = state[key]
            new[key] = (status, t, r, balance, v + 1)
            kinds += [(key, "update_preimage"), (key, "update_postimage")]
        elif key not in state and op == "insert":
            new[key] = (status, tier, region, balance, 0)
            kinds.append((key, "insert"))
    return new, sorted(kinds)


def as_dict(df):
    rows = df.select("account_id", "status", "tier", "region", "balance", "version").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def seed_rows(spark, n=12):
    rows = [(i, "active", ["bronze", "gold"][i % 2], ["SP", "RJ", "MG"][i % 3], i * 1.25, 0, T0) for i in range(n)]
    return spark.createDataFrame(rows, ch.ACCOUNTS)


def ledger(spark):
    return Ledger(spark, work_dir(spark, "t"), buckets=7)


@pytest.fixture(scope="module")
def table(spark):
    """A table with a seed and four rounds, and the model's state after each version."""
    log = ledger(spark)
    log.append(seed_rows(spark), T0)
    states, kinds = [as_dict(log.read())], [[]]
    for i in range(1, 5):
        rows, raw = raw_ops(spark, i)
        version, mix = log.merge(ch.last_op_per_key(raw), at(i))
        assert version == i and sum(mix.values()) == len({r[1] for r in rows})
        state, changed = model(states[-1], rows)
        states.append(state)
        kinds.append(changed)
    return log, states, kinds


def test_every_version_reads_like_the_model(table):
    log, states, _ = table
    for version, state in enumerate(states):
        assert as_dict(log.as_of(version)) == state
    assert as_dict(log.read()) == states[-1]
    with pytest.raises(ValueError):
        log.as_of(99)


def test_change_rows(table):
    log, _, kinds = table
    for version in range(1, 5):
        got = log.changes(version, version).select("account_id", "_change_type").collect()
        assert sorted(map(tuple, got)) == kinds[version]


def test_as_of_over_change_rows_alone(table):
    log, states, _ = table
    changes = log.changes().persist()
    for version, state in enumerate(states):
        assert as_dict(ch.as_of(changes, version)) == state
    changes.unpersist()


def test_large_batch_without_broadcast(spark, table):
    """The other join strategy gives the same rows."""
    log, states, _ = table
    rows, raw = raw_ops(spark, 9, n=300, keys=60)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = ch.merge_changes(log.read(), ch.last_op_per_key(raw), 5, F.lit(at(5)))
        assert as_dict(ch.apply_changes(log.read(), changes)) == model(states[-1], rows)[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_small_batch_does_not_shuffle_the_state(spark, table):
    log, _, _ = table
    ops = spark.createDataFrame(ch.last_op_per_key(raw_ops(spark, 1)[1]).collect(), ch.OPS)
    plan = ch.merge_changes(log.as_of(0), ops.hint("broadcast"), 5, F.lit(T0))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical


def files(spark, folder):
    fs, p = hadoop_path(spark, folder)
    return {f.getPath().toString() for f in fs.listStatus(p)}


def test_a_batch_reads_and_writes_only_the_buckets_it_touches(spark):
    log = ledger(spark)
    log.append(seed_rows(spark, 40), T0)
    row = (3, "update", "closed", "gold", "SP", 7.5, at(1))
    ops = spark.createDataFrame([row], ch.OPS)
    scan = log.touched(ops)
    assert scan.collect() and "dynamicpruning" in scan._jdf.queryExecution().executedPlan().toString()
    before = {b: files(spark, b) for b in files(spark, f"{log.root}/state") if "bucket=" in b}
    assert len(before) == 7
    log.merge(ops, at(1))
    assert sum(files(spark, b) != before[b] for b in before) == 1
    assert as_dict(log.read()) == as_dict(log.as_of(1))


def test_a_bucket_may_lose_its_last_row(spark):
    log = Ledger(spark, work_dir(spark, "t"), buckets=2)
    log.append(seed_rows(spark, 6), T0)
    ops = [(i, "delete", None, None, None, None, at(1)) for i in range(6)]
    log.merge(spark.createDataFrame(ops, ch.OPS), at(1))
    assert log.read().isEmpty() and log.as_of(1).isEmpty() and log.as_of(0).count() == 6


def test_what_a_writer_left_undone_is_finished(spark, monkeypatch):
    log = ledger(spark)
    log.append(seed_rows(spark), T0)
    rows, raw = raw_ops(spark, 1)
    state, _ = model(as_dict(log.read()), rows)
    ops = ch.last_op_per_key(raw)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "_settle", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            log.merge(ops, at(1), version=1)
    assert log.head()["version"] == 0 and log.changes().filter("_commit_version > 0").isEmpty()
    assert log.merge(ops, at(2), version=1)[0] == 1  # the same batch again: finished, not applied twice
    assert as_dict(log.read()) == state == as_dict(log.as_of(1))
    log._settle(1, at(2))  # repeating a step changes nothing
    assert as_dict(log.read()) == state
    with pytest.raises(ValueError):
        log.merge(ops, at(3), version=9)


def test_spans_are_listed_only_where_they_are_read(spark, monkeypatch):
    monkeypatch.setattr("changeflow.sources.ledger.SPAN", 2)
    log = ledger(spark)
    log.append(seed_rows(spark), T0)
    for i in range(1, 5):
        log.merge(ch.last_op_per_key(raw_ops(spark, i)[1]), at(i))
    plan = log.changes(3, 3)
    assert {r[0] for r in plan.select("_commit_version").distinct().collect()} == {3}
    assert all("_span=1" in f for f in plan.inputFiles())
    assert as_dict(log.as_of(4)) == as_dict(log.read())


def test_upsert_view_ignores_order_and_repeats(table):
    log, states, _ = table
    live = ms.change_messages(log.changes(1))
    hydrated = ms.hydrate_messages(log.as_of(2), 2, F.lit(at(2)))
    again = ms.hydrate_messages(log.as_of(3), 3, F.lit(at(3)))
    for topic in (
        hydrated.unionByName(live),
        live.unionByName(hydrated).unionByName(live),
        again.unionByName(live).unionByName(hydrated).orderBy(F.rand(1)),
    ):
        view = ms.upsert_view(ms.parse_messages(topic))
        assert as_dict(view) == states[-1]


def test_message_format(spark):
    row = (7, "active", None, "SP", 1.5, 2, datetime(2024, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc), "delete", 9, T0)
    changes = spark.createDataFrame([row], ch.CHANGES)
    (got,) = ms.change_messages(changes).collect()
    assert got["key"] == "7"
    assert got["value"] == (
        '{"account_id":7,"status":"active","region":"SP","balance":1.5,"version":2,'
        '"updated_at":"2024-01-02T03:04:05.678Z","deleted":true,"_change_type":"delete",'
        '"_commit_version":9,"_commit_timestamp":"2024-01-01T00:00:00.000Z"}'
    )


def run_feed(log, out, checkpoint, **kw):
    feed.publish_changes(log, feed.folder_sink(out), checkpoint, **kw).awaitTermination()


def published(spark, out):
    return ms.parse_messages(spark.read.schema("key string, value string").parquet(out))


def test_stream_resumes_without_repeats(spark):
    log = ledger(spark)
    out, checkpoint = work_dir(spark, "topic"), work_dir(spark, "cp")
    log.append(seed_rows(spark), T0)
    log.merge(ch.last_op_per_key(raw_ops(spark, 1)[1]), at(1))
    run_feed(log, out, checkpoint, starting="earliest", versions_per_batch=1)
    assert {r[0] for r in published(spark, out).select("_commit_version").distinct().collect()} == {0, 1}
    log.merge(ch.last_op_per_key(raw_ops(spark, 2)[1]), at(2))
    run_feed(log, out, checkpoint, starting="earliest")
    run_feed(log, out, checkpoint, starting="earliest")
    got = published(spark, out)
    expected = ms.parse_messages(ms.change_messages(log.changes()))
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_notes_do_not_pile_up(spark):
    """What a consumer has read leaves its folder, so a listing stays as long as what is new."""
    log = ledger(spark)
    out, checkpoint = work_dir(spark, "topic"), work_dir(spark, "cp")
    log.append(seed_rows(spark), T0)
    most = 0
    for i in range(1, 6):
        run_feed(log, out, checkpoint)
        log.merge(ch.last_op_per_key(raw_ops(spark, i)[1]), at(i))
        (folder,) = log.feeds()
        most = max(most, sum(".parquet" in f for f in files(spark, folder)))
    assert most <= 3
    run_feed(log, out, checkpoint)
    assert as_dict(ms.upsert_view(published(spark, out))) == as_dict(log.read())
    # A second consumer hears of everything too, from the table as it is.
    fresh = work_dir(spark, "topic")
    run_feed(log, fresh, work_dir(spark, "cp"), consumer="second")
    assert as_dict(ms.upsert_view(published(spark, fresh))) == as_dict(log.read())


def test_stateful_upsert_survives_a_restart(spark, table):
    log, states, _ = table
    topic, out, cp = (work_dir(spark, n) for n in ("topic", "view", "cp"))

    def consume():
        stream = spark.readStream.schema("key string, value string").parquet(topic)
        feed.upsert_stream(stream, out, cp).awaitTermination()

    ms.change_messages(log.changes(3)).write.mode("append").parquet(topic)
    consume()
    # Older changes and the hydration arrive late.
    ms.change_messages(log.changes(1, 2)).write.mode("append").parquet(topic)
    ms.hydrate_messages(log.as_of(1), 1, F.lit(at(1))).write.mode("append").parquet(topic)
    consume()
    assert as_dict(feed.read_upserts(spark, out)) == states[-1]


def test_maintenance_clock(spark):
    schema = "version long, timestamp timestamp, operation string"
    history = [(0, T0, "WRITE")]

    def clock(hours):
        return mt.due(mt.hours_since(spark.createDataFrame(history, schema), "OPTIMIZE", F.lit(at(hours))), 1.0).first()

    assert clock(1)["hours"] is None and clock(1)["due"] is True
    history.append((1, at(1), "OPTIMIZE"))
    assert clock(1.5)["due"] is False and clock(2)["due"] is True
    assert clock(3.5)["hours"] == 2.5


def test_migrations_run_once_and_in_order(spark):
    state, ran = work_dir(spark, "m"), []
    first, second = ("m1", lambda s: ran.append("m1")), ("m2", lambda s: ran.append("m2"))

    def broken(_):
        raise OSError("boom")

    assert mg.run_migrations(spark, [first], state, T0) == ["m1"]
    with pytest.raises(OSError):
        mg.run_migrations(spark, [first, ("m2", broken)], state, T0)
    assert mg.run_migrations(spark, [first, second], state, T0) == ["m2"]
    assert mg.run_migrations(spark, [first, second], state, T0) == []
    assert ran == ["m1", "m2"]


def test_topic_sink_on_a_processing_time_trigger(spark):
    """Appends in version order per key; any batch format stands in for the broker."""
    log = ledger(spark)
    log.append(seed_rows(spark, 5), T0)
    out = work_dir(spark, "topic")
    sink = feed.topic_sink({"path": out}, fmt="json")
    query = feed.publish_changes(log, sink, work_dir(spark, "cp"), trigger="1 second")
    try:
        log.merge(ch.last_op_per_key(raw_ops(spark, 1)[1]), at(1))
        query.processAllAvailable()
        log.merge(ch.last_op_per_key(raw_ops(spark, 2)[1]), at(2))
        query.processAllAvailable()
    finally:
        query.stop()
    feed.hydrate(log, sink)
    topic = ms.parse_messages(spark.read.schema("key string, value string").json(out))
    assert as_dict(ms.upsert_view(topic)) == as_dict(log.read())
    assert {r[0] for r in topic.select("_change_type").distinct().collect()} > {"insert", "hydrate"}


def test_append_refuses_keys_it_could_not_keep(spark):
    log = ledger(spark)
    rows = seed_rows(spark, 5)
    with pytest.raises(ValueError, match="twice"):
        log.append(rows.unionByName(rows), T0)
    log.append(rows, T0)
    with pytest.raises(ValueError, match="twice"):
        log.append(rows.limit(2), at(1))
    assert log.read().count() == rows.count()


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from changeflow.session import shared_dir

    def session(master, named=None):
        conf = SimpleNamespace(get=lambda key, default=None: named or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_dir(session("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_dir(session("local[4]"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session(master))


def test_upsert_state_is_kept_by_rocksdb(spark):
    topic, out, cp = (work_dir(spark, n) for n in ("topic", "view", "cp"))
    log = ledger(spark)
    log.append(seed_rows(spark, 5), T0)
    feed.ms.change_messages(log.changes()).write.parquet(topic)
    before = spark.conf.get(feed.PROVIDER)
    query = feed.upsert_stream(spark.readStream.schema("key string, value string").parquet(topic), out, cp)
    query.awaitTermination()
    names = [k for k in query.lastProgress["stateOperators"][0]["customMetrics"] if k.startswith("rocksdb")]
    assert names and spark.conf.get(feed.PROVIDER) == before


def test_a_load_counts_what_it_writes(spark):
    rows, path = seed_rows(spark, 9), work_dir(spark, "load")
    assert ld.load(rows, path, 9, {"closed": F.col("status") == "closed"}) == {"rows": 9, "closed": 0}
    assert as_dict(spark.read.schema(rows.schema).parquet(path)) == as_dict(rows)
    for expected, none_of, message in (
        (10, None, "9 rows instead of 10"),
        (None, {"in SP": F.col("region") == "SP"}, "3 rows: in SP"),
    ):
        refused = work_dir(spark, "load")
        with pytest.raises(ld.WrongCount, match=message):
            ld.load(rows, refused, expected, none_of)
        assert not path_exists(spark, refused)
    assert ld.load(rows.limit(0), work_dir(spark, "load"), 0) == {"rows": 0}


def test_upserts_touch_only_buckets_of_changed_keys(spark):
    log = ledger(spark)
    log.append(seed_rows(spark, 40), T0)
    topic, out, cp = (work_dir(spark, n) for n in ("topic", "view", "cp"))

    def consume(messages):
        messages.write.mode("append").parquet(topic)
        stream = spark.readStream.schema("key string, value string").parquet(topic)
        feed.upsert_stream(stream, out, cp, buckets=6).awaitTermination()

    consume(ms.change_messages(log.changes()))
    before = {b: files(spark, b) for b in files(spark, out) if "bucket=" in b}
    assert len(before) == 6
    log.merge(spark.createDataFrame([(3, "delete", None, None, None, None, at(1))], ch.OPS), at(1))
    consume(ms.change_messages(log.changes(1)))
    assert sum(files(spark, b) != before[b] for b in before) == 1
    assert as_dict(feed.read_upserts(spark, out)) == as_dict(log.read())
