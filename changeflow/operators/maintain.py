"""The maintenance clock: stored history decides, not a counter in memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def history_head(commits: DataFrame) -> DataFrame:
    """The newest commit."""
    return commits.orderBy(F.desc("version")).limit(1).select("version", "operation")


def hours_since(commits: DataFrame, operation: str, now: Column) -> DataFrame:
    """Hours since the last commit of an operation; null if there never was one."""
    last = F.max(F.col("timestamp"))
    hours = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(last)) / F.lit(3.6e9)
    return commits.filter(F.col("operation") == operation).agg(hours.alias("hours"))


def due(clock: DataFrame, interval_hours: float) -> DataFrame:
    """Maintenance is due after the interval, and at once if it never ran."""
    return clock.select(
        "hours", F.coalesce(F.col("hours") >= interval_hours, F.lit(True)).alias("due")
    )
