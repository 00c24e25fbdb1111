"""A keyed table and its change rows, as two partitioned Parquet folders.

    changes/_span=<s>/_commit_version=<v>/   the change rows of one batch; spans hold `SPAN` versions
    state/bucket=<b>/                        the rows alive, dealt by a hash of their key
    feeds/<name>/                            one row per batch for a consumer, gone once it has read it
    head/<version>-<microseconds>/           newest version and its time, an empty folder made last

The table after any version follows from the change rows (`operators.changes.as_of`). The state saves reading them
all: a batch is joined with the state on bucket and key, so dynamic partition pruning opens only buckets the batch
touches, and only those are written again, each replaced as a whole when the job commits.

One writer at a time. Its steps can be repeated: change rows first, then the buckets they touch, then the head; what a
writer left undone is finished by the next one from the change rows. `read` shows buckets as they are now; whoever must
not see a batch in between reads `as_of` a version.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators import changes as ch
from changeflow.session import append_row, delete_path, hadoop_path, listed, path_exists

SPAN = 1000  # versions in one folder
BUCKETS = 64
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class Ledger:
    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType = ch.ACCOUNTS, key: str = ch.KEY, buckets: int = BUCKETS
    ):
        self.spark, self.root, self.schema, self.key, self.buckets = spark, root.rstrip("/"), schema, key, buckets
        self.change_schema = T.StructType(schema.fields + [f for f in ch.CHANGES.fields if f.name.startswith("_")])

    # -- reads -------------------------------------------------------------

    def head(self) -> Row | None:
        """The newest version and its time."""
        marks = self._marks()
        if not marks:
            return None
        version, micros = max(marks)
        return Row(version=version, timestamp=EPOCH + timedelta(microseconds=micros))

    def _marks(self) -> list[tuple[int, int]]:
        names = [path.rstrip("/").rsplit("/", 1)[-1] for path in self._listed("head")]
        return [(int(v), int(t)) for v, _, t in (name.partition("-") for name in names)]

    def _listed(self, folder: str) -> list[str]:
        return listed(self.spark, f"{self.root}/{folder}")

    def _version(self) -> int:
        head = self.head()
        return -1 if head is None else head["version"]

    def state(self) -> DataFrame:
        """The rows alive, with their `bucket`. A row without key only marks that its bucket was written."""
        path = f"{self.root}/state"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())]))
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(path).filter(F.col(self.key).isNotNull())

    def read(self) -> DataFrame:
        """The table now."""
        return self.state().drop("bucket")

    def _changes_path(self, version: int) -> str:
        return f"{self.root}/changes/_span={version // SPAN}/_commit_version={version}"

    def changes(self, first: int = 0, last: int | None = None) -> DataFrame:
        """Change rows of the versions `first..last`. Only the folders of their spans are listed."""
        last = self._version() if last is None else min(last, self._version())
        spans = [f"{self.root}/changes/_span={s}" for s in range(first // SPAN, last // SPAN + 1)] if last >= first else []
        spans = [s for s in spans if path_exists(self.spark, s)]
        if not spans:
            return self.spark.createDataFrame([], self.change_schema)
        rows = self.spark.read.schema(self.change_schema).option("basePath", f"{self.root}/changes").parquet(*spans)
        rows = rows.filter(F.col("_commit_version").between(first, last))
        return rows.select(*self.change_schema.fieldNames())

    def as_of(self, version: int) -> DataFrame:
        """The table after `version`, from its change rows."""
        if not 0 <= version <= self._version():
            raise ValueError(f"{self.root} has no version {version}")
        return ch.as_of(self.changes(0, version), key=self.key)

    # -- writes ------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def touched(self, keys: DataFrame) -> DataFrame:
        """The rows alive of these keys (one row per key).

        The comparison of the bucket holds always; it tells Spark that the keys select, and so that the buckets of a
        batch it sends to all executors are worth a partition filter.
        """
        picked = keys.select(self.key, self.bucket()).filter(F.col("bucket") >= 0)
        return self.state().join(picked, ["bucket", self.key], "left_semi").drop("bucket")

    def append(self, rows: DataFrame, now: datetime) -> int:
        """Add rows with new keys. A key that the table holds already, or that comes twice, is an error."""
        version = self._recovered() + 1
        rows = rows.select(*self.schema.fieldNames()).persist()
        try:
            twice = ch.dup_keys(rows, self.key).select(self.key)
            if version:
                twice = twice.unionByName(self.touched(rows).select(self.key))
            if known := twice.limit(5).collect():
                raise ValueError(f"{self.root} cannot take a key twice: {', '.join(str(r[0]) for r in known)}")
            self._commit(ch.as_inserts(rows, version, F.lit(now)), version, now)
        finally:
            rows.unpersist()
        return version

    def merge(self, ops: DataFrame, now: datetime, version: int | None = None) -> tuple[int, dict[str, int]]:
        """Apply one batch: one merge, one version. Returns it and the realised mix.

        The batch is cached: counting the mix fills the cache and gives Spark the exact size from which it decides
        whether to broadcast the batch. A caller that numbers its batches passes `version`; one that is applied
        already is not applied again.
        """
        newest = self._recovered()
        if newest < 0:
            raise RuntimeError(f"{self.root} holds no data yet")
        if version is not None and version > newest + 1:
            raise ValueError(f"{self.root} is at version {newest}, not {version - 1}")
        ops = ops.persist()
        try:
            mix = {r["op"]: r["n"] for r in ch.op_mix(ops).collect()}
            if version is None or version > newest:
                version = newest + 1
                changes = ch.merge_changes(self.touched(ops), ops, version, F.lit(now), self.key)
                self._commit(changes, version, now)
        finally:
            ops.unpersist()
        return version, mix

    def _commit(self, changes: DataFrame, version: int, now: datetime) -> None:
        changes.drop("_commit_version").write.mode("overwrite").parquet(self._changes_path(version))
        self._settle(version, now)

    def _recovered(self) -> int:
        """The newest version, after finishing what the last writer left undone."""
        newest = self._version()
        if path_exists(self.spark, f"{self._changes_path(newest + 1)}/_SUCCESS"):
            newest += 1
            rows = self.spark.read.schema(self.change_schema).parquet(self._changes_path(newest))
            time = rows.agg(F.max("_commit_timestamp")).first()[0]
            time = time or (self.head() or {"timestamp": EPOCH})["timestamp"]
            self._settle(newest, time)
        return newest

    def _settle(self, version: int, now: datetime) -> None:
        """Write the buckets that the version's change rows touch, tell the feeds, then move the head."""
        names = [f for f in self.change_schema.fieldNames() if f != "_commit_version"]
        rows = self.spark.read.schema(self.change_schema).parquet(self._changes_path(version)).select(*names)
        rows = rows.withColumns({"_commit_version": F.lit(version).cast("long"), "bucket": self.bucket()}).persist()
        try:
            buckets = rows.select("bucket").filter("bucket >= 0").distinct()
            old = self.state().join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket")
            new = ch.apply_changes(old, rows.drop("bucket"), self.key).withColumn("bucket", self.bucket())
            # A bucket whose last row was deleted has to be written all the same.
            marks = buckets.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields], "bucket")
            out = new.unionByName(marks).hint("rebalance", "bucket").write.mode("overwrite")
            out.option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.root}/state")
        finally:
            rows.unpersist()
        for feed in self.feeds():
            append_row(self.spark, feed, "version bigint", version)
        self._move_head(version, now)

    def _move_head(self, version: int, now: datetime) -> None:
        now = now if now.tzinfo else now.astimezone()
        before = [m for m in self._marks() if m[0] < version]
        micros = (now - EPOCH) // timedelta(microseconds=1)
        fs, p = hadoop_path(self.spark, f"{self.root}/head/{version}-{micros}")
        fs.mkdirs(p)
        for v, t in before:
            delete_path(self.spark, f"{self.root}/head/{v}-{t}")

    # -- consumers ---------------------------------------------------------

    def feeds(self) -> list[str]:
        """The folders of the consumers that want to hear of new versions."""
        return self._listed("feeds")

    def subscribe(self, name: str, earliest: bool = False) -> str:
        """The consumer's folder. Versions so far are put into it with `earliest`, later ones in any case."""
        path = f"{self.root}/feeds/{name}"
        if not path_exists(self.spark, path):
            fs, p = hadoop_path(self.spark, path)
            fs.mkdirs(p)
            # One file per version, as later ones come, so a batch can be as small as one.
            for v in range(self._version() + 1 if earliest else 0):
                append_row(self.spark, path, "version bigint", v)
        return path
