"""Change rows as keyed JSON messages, and the view a consumer keeps of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.changes import ACCOUNTS, DELETE, KEY, PRE

MESSAGE = T.StructType(
    ACCOUNTS.fields
    + [
        T.StructField("deleted", T.BooleanType()),
        T.StructField("_change_type", T.StringType()),
        T.StructField("_commit_version", T.LongType()),
        T.StructField("_commit_timestamp", T.TimestampType()),
    ]
)

HYDRATE = "hydrate"


def _message(rows: DataFrame, key: str) -> DataFrame:
    """Key and JSON value. Null fields are left out, timestamps have milliseconds."""
    return rows.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*MESSAGE.fieldNames())).alias("value"),
    )


def change_messages(changes: DataFrame, key: str = KEY) -> DataFrame:
    """One message per change; the consumer needs new images only."""
    live = changes.filter(F.col("_change_type") != PRE)
    return _message(live.withColumn("deleted", F.col("_change_type") == DELETE), key)


def hydrate_messages(snapshot: DataFrame, version: int, timestamp: Column, key: str = KEY) -> DataFrame:
    """Every live row at `version`, in the same shape as a change message."""
    return _message(
        snapshot.withColumns(
            {
                "deleted": F.lit(False),
                "_change_type": F.lit(HYDRATE),
                "_commit_version": F.lit(version).cast("bigint"),
                "_commit_timestamp": timestamp.cast("timestamp"),
            }
        ),
        key,
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    return messages.select("key", F.from_json("value", MESSAGE).alias("m")).select("key", "m.*")


def newest_message(parsed: DataFrame) -> DataFrame:
    """The winning message of each key, deletes included.

    The greatest commit version wins whatever the order of arrival. A change
    made exactly at the hydrated version ties with the hydrated row and holds
    the same state; the live message is preferred, so origin counts are stable.
    """
    rank = F.struct(F.col("_commit_version"), F.col("_change_type") != HYDRATE)
    rest = [c for c in parsed.columns if c != "key"]
    return (
        parsed.groupBy("key")
        .agg(F.max_by(F.struct(*rest), rank).alias("r"))
        .select("key", "r.*")
    )


def upsert_view(parsed: DataFrame) -> DataFrame:
    """Rows alive in the consumer's keyed table."""
    return newest_message(parsed).filter(~F.col("deleted"))


def origin_parity(view: DataFrame) -> DataFrame:
    return view.groupBy("_change_type").agg(F.count(F.lit(1)).alias("n"))
