"""Loads that check themselves: rows are counted while they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from changeflow.session import delete_path


class WrongCount(RuntimeError):
    """A load wrote another number of rows than it should have, or rows that may not be there."""


def load(
    rows: DataFrame, path: str, expected: int | None = None, none_of: dict[str, Column] | None = None
) -> dict[str, int]:
    """Write the rows and return what was counted in passing: `rows`, and per name in `none_of` its rows.

    The figures are metrics of the write itself, so the data is read once. If the number of rows is not the expected
    one, or any row fulfils a condition of `none_of`, the folder is removed again and the load fails.
    """
    watch, unwanted = Observation("load"), none_of or {}
    counts = [F.count_if(condition).alias(name) for name, condition in unwanted.items()]
    rows.observe(watch, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
    seen = {name: int(n) for name, n in watch.get.items()}
    wrong = [f"{seen[name]} rows: {name}" for name in unwanted if seen[name]]
    if expected is not None and seen["rows"] != expected:
        wrong.insert(0, f"{seen['rows']} rows instead of {expected}")
    if wrong:
        delete_path(rows.sparkSession, path)
        raise WrongCount(f"{path}: " + "; ".join(wrong))
    return seen
