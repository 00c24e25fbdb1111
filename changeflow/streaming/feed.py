"""The change feed as a stream, and the keyed view its consumer keeps.

A consumer has a folder in which the ledger notes every new version, last of
its data. The stream reads these notes; each micro-batch opens the change rows
of its versions. Notes that were read are moved to an archive, so the folder
does not grow with the age of the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators import messages as ms
from changeflow.operators.changes import as_inserts
from changeflow.session import append_row, path_exists
from changeflow.sources.ledger import BUCKETS, Ledger

# A sink takes the messages of one micro-batch and its number.
Sink = Callable[[DataFrame, int], None]

SNAPSHOT_BATCH = -1

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def folder_sink(path: str, fmt: str = "parquet") -> Sink:
    """Messages in one folder per batch: a repeated batch replaces itself."""

    def write(messages: DataFrame, batch: int) -> None:
        messages.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch}")

    return write


def topic_sink(options: dict[str, str], fmt: str = "kafka") -> Sink:
    """Messages appended to a topic, at least once. Needs the connector on the class path.

    Brokers, topic and credentials come in as options. Messages of a key share
    a task and go out in version order, so the broker keeps their order.
    """

    def write(messages: DataFrame, batch: int) -> None:
        version = F.get_json_object("value", "$._commit_version").cast("bigint")
        ordered = messages.repartition("key").sortWithinPartitions("key", version)
        ordered.write.format(fmt).options(**options).mode("append").save()

    return write


def publish_batch(messages: DataFrame, sink: Sink) -> None:
    sink(messages, SNAPSHOT_BATCH)


def hydrate(table: Ledger, sink: Sink) -> int:
    """Publish every live row at the newest version, pinned. Returns that version.

    Needs no coordination with writer or stream: later changes carry a greater
    version and win in the consumer whatever the order of arrival.
    """
    head = table.head()
    snapshot = table.as_of(head["version"])
    publish_batch(ms.hydrate_messages(snapshot, head["version"], F.lit(head["timestamp"])), sink)
    return head["version"]


def _pinned_start(table: Ledger, sink: Sink, checkpoint: str, starting: str) -> int:
    """The version up to which the stream has nothing to publish itself.

    With `starting='snapshot'` the first run publishes the current table as
    inserts and notes its version beside the checkpoint; the note comes last,
    so a crash before it repeats the snapshot.
    """
    if starting == "earliest":
        return -1
    note = f"{checkpoint}-start"
    if not path_exists(table.spark, f"{note}/_SUCCESS"):
        head = table.head()
        rows = as_inserts(table.as_of(head["version"]), head["version"], F.lit(head["timestamp"]))
        publish_batch(ms.change_messages(rows, table.key), sink)
        append_row(table.spark, note, "version bigint", head["version"])
    return table.spark.read.schema("version bigint").parquet(note).first()["version"]


def publish_changes(
    table: Ledger,
    sink: Sink,
    checkpoint: str,
    starting: str = "snapshot",
    trigger: str | None = None,
    versions_per_batch: int = 100,
    consumer: str = "main",
) -> StreamingQuery:
    """Publish the change feed from where the checkpoint stands.

    `trigger` is a processing-time interval such as '30 seconds'; without one
    the query handles what is there and stops. Delivery is at least once. Two
    consumers need two names and two checkpoints.
    """
    notes = table.subscribe(consumer, earliest=starting == "earliest")  # before the snapshot: nothing falls between
    start = _pinned_start(table, sink, checkpoint, starting)

    def publish(batch: DataFrame, number: int) -> None:
        # One row per note, so at most `versions_per_batch` rows.
        due = sorted({r["version"] for r in batch.collect() if r["version"] > start})
        if not due:
            return
        changes = table.spark.read.schema(table.change_schema).option("basePath", f"{table.root}/changes")
        changes = changes.parquet(*[table._changes_path(v) for v in due]).select(*table.change_schema.fieldNames())
        sink(ms.change_messages(changes, table.key), number)

    stream = (
        table.spark.readStream.schema("version bigint")
        .option("maxFilesPerTrigger", versions_per_batch)
        .option("cleanSource", "archive")
        .option("sourceArchiveDir", f"{table.root}/read/{consumer}")
        .parquet(notes)
    )
    writer = stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def upsert_stream(messages: DataFrame, out: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the newest message of each key of a message stream as a table under `out`.

    A stateful aggregation: the state store holds one row per key, late and
    repeated messages lose by version. Each batch lays the keys it changed over
    the buckets of the table they are in; other buckets are neither read nor
    written, and a repeated batch gives the same table. One row per key for
    ever does not fit into executors' memory, so the state is kept by RocksDB
    on their disks, whatever the session's provider is.
    """
    conf = messages.sparkSession.conf
    before = conf.get(PROVIDER)
    conf.set(PROVIDER, ROCKSDB)
    try:
        return _upsert_stream(messages, out, checkpoint, buckets)
    finally:
        conf.set(PROVIDER, before)  # the started query keeps what it was started with


def _upsert_stream(messages: DataFrame, out: str, checkpoint: str, buckets: int) -> StreamingQuery:
    newest = ms.newest_message(ms.parse_messages(messages))
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")

    def write(rows: DataFrame, batch: int) -> None:
        rows = rows.withColumn("bucket", bucket).persist()
        try:
            if rows.isEmpty():
                return
            table = rows
            if path_exists(rows.sparkSession, out):
                # As many rows as buckets at most, and a partition filter for the scan of the table.
                touched = F.broadcast(rows.filter("bucket >= 0").select("bucket").distinct())
                kept = rows.sparkSession.read.schema(rows.schema).parquet(out).join(touched, "bucket", "left_semi")
                kept = kept.join(rows.select("key"), "key", "left_anti")
                table = kept.unionByName(rows.hint("rebalance"))
            table = table.hint("rebalance", "bucket").write.mode("overwrite")
            table.option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(out)
        finally:
            rows.unpersist()

    return (
        newest.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserts(spark: SparkSession, out: str) -> DataFrame:
    """The view `upsert_stream` keeps: rows alive after the last batch, as they are stored."""
    return spark.read.parquet(out).drop("bucket").filter(~F.col("deleted"))
