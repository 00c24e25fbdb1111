"""Incident reports: markdown with front matter -> keyed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions import frontmatter as fm
from changeflow.functions.text import unpacked

NO_KEY, KEY_NOT_TEXT, EMPTY_BODY = "no key", "key is a list", "empty body"


def parsed(raw: DataFrame) -> DataFrame:
    """Adds `fm` and `body` to rows with `content`. Row-local, no shuffle."""
    kept = [c for c in raw.columns if c != "content"]
    return raw.select(*kept, unpacked(fm.parse_document("content")))


def keyed(docs: DataFrame) -> DataFrame:
    """Adds `dedup_key` and `skip_reason` (null for a good report).

    An empty `dedup_key`, be it text or a list, falls back to `incident_key`.
    """
    own, fallback = fm.value(F.col("fm"), "dedup_key"), fm.value(F.col("fm"), "incident_key")

    def filled(entry):
        return F.when(entry["is_list"], F.size(entry["vals"]) > 0).otherwise(F.get(entry["vals"], F.lit(0)) != "")

    entry = F.when(filled(own), own).when(filled(fallback), fallback)
    reason = (
        F.when(F.col("_key").isNull(), NO_KEY)
        .when(F.col("_key.is_list"), KEY_NOT_TEXT)
        .when(F.col("body") == "", EMPTY_BODY)
    )
    return (
        docs.withColumn("_key", entry)
        .withColumn("dedup_key", fm.text(F.col("_key")))
        .withColumn("skip_reason", reason)
        .drop("_key")
    )


def reports(raw: DataFrame) -> DataFrame:
    """`dedup_key, fm, body, path` of the reports that can be indexed."""
    return keyed(parsed(raw)).filter("skip_reason is null").drop("skip_reason")


def report_skips(raw: DataFrame) -> DataFrame:
    """The reports left out, each with the reason."""
    return keyed(parsed(raw)).filter("skip_reason is not null").drop("fm", "body", "dedup_key")


def front_matter_rows(docs: DataFrame, id_column: str) -> DataFrame:
    """Front matter as rows, one per value; an empty list gives one row without a value."""
    return (
        docs.select(id_column, F.explode(fm.last_wins(F.col("fm"))).alias("e"))
        .select(id_column, "e.key", "e.is_list", F.posexplode_outer("e.vals").alias("pos", "value"))
    )
