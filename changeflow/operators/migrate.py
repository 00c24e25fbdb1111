"""Ordered migrations with their state in a table.

Rules for a registry: never remove or reorder entries, the id is the identity;
every migration is idempotent, since a crash between applying and recording one
runs it again; migrations write, so the table's writer must be stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import append_row, path_exists

STATE = "id string, applied_at timestamp"

Migration = tuple[str, Callable[[SparkSession], None]]


def pending(registry: DataFrame, applied: DataFrame) -> DataFrame:
    """Entries (`ord`, `id`) of the registry that were not applied, in order."""
    return registry.join(applied.select("id"), "id", "left_anti").select("ord", "id").orderBy("ord")


def run_migrations(spark: SparkSession, registry: list[Migration], state: str, now: datetime) -> list[str]:
    """Apply what is missing, in order, recording each one after it ran."""
    if not path_exists(spark, state):
        spark.createDataFrame([], STATE).write.parquet(state)
    known = spark.createDataFrame([(i, mid) for i, (mid, _) in enumerate(registry)], "ord int, id string")
    todo = [r["id"] for r in pending(known, spark.read.schema(STATE).parquet(state)).collect()]
    actions = dict(registry)
    for mid in todo:
        actions[mid](spark)
        append_row(spark, state, STATE, mid, now)
    return todo
