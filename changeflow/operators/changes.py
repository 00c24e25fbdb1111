"""Keyed change batches: last operation per key, merge, change rows, views.

A table is `account_id, status, tier, region, balance, version, updated_at`. A
batch of operations has the same columns, `op` instead of `version`, and after
`last_op_per_key` at most one row per key. Nothing here assumes a table format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

KEY = "account_id"

ACCOUNTS = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("tier", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("balance", T.DoubleType()),
        T.StructField("version", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

OPS = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("tier", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("balance", T.DoubleType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

CHANGES = T.StructType(
    ACCOUNTS.fields
    + [
        T.StructField("_change_type", T.StringType()),
        T.StructField("_commit_version", T.LongType()),
        T.StructField("_commit_timestamp", T.TimestampType()),
    ]
)

INSERT, PRE, POST, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def last_op_per_key(ops: DataFrame, key: str = KEY, order: str = "seq") -> DataFrame:
    """The last generated operation of each key.

    The literal `= 1` lets Spark keep one row per key in every map task before
    the shuffle, so a hot key costs one row per task, not its whole history.
    """
    newest = Window.partitionBy(key).orderBy(F.col(order).desc())
    return ops.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn", order)


def op_mix(ops: DataFrame) -> DataFrame:
    return ops.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def max_key(state: DataFrame, key: str = KEY) -> DataFrame:
    return state.agg(F.coalesce(F.max(key), F.lit(-1).cast("bigint")).alias("m"))


def dup_keys(rows: DataFrame, key: str = KEY) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def batch_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one batch missing from the other, both ways, with multiplicity."""
    only_left = left.exceptAll(right).withColumn("side", F.lit("left"))
    only_right = right.exceptAll(left).withColumn("side", F.lit("right"))
    return only_left.unionByName(only_right)


def merge_changes(
    state: DataFrame, ops: DataFrame, version: int, timestamp: Column, key: str = KEY
) -> DataFrame:
    """Change rows that applying `ops` to `state` produces.

    matched + delete removes the row; matched + update sets status, balance,
    updated_at and raises version (tier and region never change); unmatched +
    insert adds a row with version 0; anything else does nothing.

    The state is read once. Reducing it to the keys of the batch first means
    that with a batch under Spark's broadcast threshold the state is filtered
    in place, and only rows the batch touches are ever shuffled.
    """
    fields = [f for f in state.columns if f != key]
    updated = {"status": "status", "balance": "balance", "version": "old.version + 1", "updated_at": "updated_at"}
    after = _struct({f: updated.get(f, f"old.{f}") for f in fields})
    fresh = _struct({f: "0L" if f == "version" else f for f in fields})

    def image(kind: str, row: str) -> str:
        return _struct({"kind": f"'{kind}'", "row": row})

    images = f"""
        CASE WHEN old IS NOT NULL AND op = 'delete' THEN array({image(DELETE, "old")})
             WHEN old IS NOT NULL AND op = 'update' THEN array({image(PRE, "old")}, {image(POST, after)})
             WHEN old IS NULL AND op = 'insert' THEN array({image(INSERT, fresh)})
        END"""
    touched = state.join(ops.select(key), key, "left_semi").selectExpr(
        key, f"{_struct({f: f for f in fields})} AS old"
    )
    return (
        ops.join(touched, key, "left")
        .selectExpr(key, f"inline({images}) AS (_change_type, row)")
        .select(
            key,
            "row.*",
            "_change_type",
            F.lit(version).cast("bigint").alias("_commit_version"),
            timestamp.cast("timestamp").alias("_commit_timestamp"),
        )
    )


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def as_inserts(state: DataFrame, version: int, timestamp: Column) -> DataFrame:
    """A whole state as change rows, the way a first read of the feed shows it."""
    return state.select(
        "*",
        F.lit(INSERT).alias("_change_type"),
        F.lit(version).cast("bigint").alias("_commit_version"),
        timestamp.cast("timestamp").alias("_commit_timestamp"),
    )


def latest_change(changes: DataFrame, key: str = KEY) -> DataFrame:
    """The newest change of each key, deletes included. Combines before the shuffle."""
    rest = ", ".join(c for c in changes.columns if c != key)
    return (
        changes.filter(f"_change_type <> '{PRE}'")
        .groupBy(key)
        .agg(F.expr(f"max_by(struct({rest}), _commit_version) AS row"))
        .select(key, "row.*")
    )


def as_of(changes: DataFrame, version: int | None = None, key: str = KEY) -> DataFrame:
    """The table after `version`, from its change rows alone."""
    if version is not None:
        changes = changes.filter(F.col("_commit_version") <= version)
    state = [c for c in changes.columns if not c.startswith("_")]
    return latest_change(changes, key).filter(F.col("_change_type") != DELETE).select(*state)


def apply_changes(state: DataFrame, changes: DataFrame, key: str = KEY) -> DataFrame:
    """`state` with later changes laid over it.

    Only the changes are grouped. The state is anti-joined with their keys, a
    broadcast join while the keys stay under Spark's threshold.

    Spark 4.1 takes a union of two inputs hashed on one key as hashed on that
    key, and a later join on it fails once adaptive execution has coalesced one
    of them. Rebalancing the small side leaves nothing to infer.
    """
    keys = changes.filter(f"_change_type <> '{PRE}'").select(key).distinct()
    live = latest_change(changes, key).filter(f"_change_type <> '{DELETE}'").select(*state.columns)
    return state.join(keys, key, "left_anti").unionByName(live.hint("rebalance"))
