"""Reports joined with their artefacts, and cut into points to index."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import frontmatter as fm
from changeflow.functions.chunking import OVERLAP, SEPARATOR, SIZE, chunks
from changeflow.functions.ids import point_id
from changeflow.functions.sections import sections

UNVERIFIED = "unverified"


def attach(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join with a side that has one row per key.

    The left side may hold one key in a third of its rows. Joining on the key
    and a second column computed from it changes no result but makes Spark
    shuffle both sides for this very join, which is what lets adaptive
    execution split an oversized partition of the left side. (Coming straight
    out of an aggregation, the right side would not be shuffled again, and the
    partition would not be split.) A right side small enough is broadcast.
    """
    check = F.crc32(F.col(key).cast("binary"))
    return (
        left.withColumn("_check", check)
        .join(right.withColumn("_check", check), [key, "_check"], "left")
        .drop("_check")
    )


def _texts(key: str) -> Column:
    """Value of a key as text; a list is joined by commas."""
    return F.array_join(fm.value(F.col("fm"), key)["vals"], ",")


def enrich(
    reports: DataFrame, conclusions: DataFrame, confirmations: DataFrame, run_id: str
) -> DataFrame:
    """Adds `metadata`, the payload every point of a report carries.

    A report without a conclusion has no outcome, verdict or confidence. One
    without a confirmation is 'unverified'; what its own front matter says
    about that is ignored on purpose. The two slim sides are joined with each
    other first, so the report texts move once.
    """
    siblings = conclusions.select("dedup_key", "outcome", "verdict", "confidence").join(
        confirmations.select("dedup_key", "confirmation"), "dedup_key", "full"
    )
    facts = reports.select(
        "dedup_key",
        "path",
        "body",
        F.coalesce(_texts("incident_key"), F.col("dedup_key")).alias("incident_key"),
        F.coalesce(_texts("namespace"), F.lit("")).alias("namespace"),
        F.coalesce(fm.value(F.col("fm"), "alertnames")["vals"], F.array().cast("array<string>")).alias("alertnames"),
        F.coalesce(_texts("fired_at"), F.lit("")).alias("fired_at"),
        F.coalesce(_texts("triaged_at"), F.lit("")).alias("triaged_at"),
    )
    return attach(facts, siblings, "dedup_key").select(
        "dedup_key",
        "path",
        "body",
        F.struct(
            "dedup_key",
            "incident_key",
            "namespace",
            "alertnames",
            "fired_at",
            "triaged_at",
            F.coalesce("confirmation", F.lit(UNVERIFIED)).alias("confirmation"),
            F.lit(run_id).alias("run_id"),
            "outcome",
            "verdict",
            "confidence",
        ).alias("metadata"),
    )


def _points(enriched: DataFrame, suffix: Column, text: Column) -> DataFrame:
    return enriched.select(
        point_id(F.col("dedup_key"), suffix).alias("point_id"),
        "dedup_key",
        "path",
        suffix.alias("suffix"),
        text.alias("text"),
        F.col("metadata").withField("section", F.nullif(suffix, F.lit(""))).alias("metadata"),
    )


def points_whole(enriched: DataFrame) -> DataFrame:
    """One point per report: its whole body."""
    return _points(enriched, F.lit(""), F.col("body"))


def section_rows(reports: DataFrame) -> DataFrame:
    """One row per recognised section."""
    kept = [c for c in reports.columns if c != "body"]
    return reports.select(*kept, F.explode(sections("body")).alias("s")).select(
        *kept, "s.section", "s.text"
    )


def points_sections(enriched: DataFrame) -> DataFrame:
    """One point per recognised section of a report."""
    return _points(section_rows(enriched), F.col("section"), F.col("text"))


def chunk_rows(
    docs: DataFrame, text: str = "text", size: int = SIZE, overlap: int = OVERLAP, separator: str = SEPARATOR
) -> DataFrame:
    """One row per chunk: the other columns, `chunk` (from 0) and `text`."""
    kept = [c for c in docs.columns if c != text]
    return docs.select(*kept, F.posexplode(chunks(text, size, overlap, separator)).alias("chunk", "text"))


def chunk_points(chunked: DataFrame, run_id: str) -> DataFrame:
    """Points of chunked documents: id of `path#chunk`, payload path, chunk, run."""
    return chunked.select(
        point_id(F.col("path"), F.col("chunk").cast("string")).alias("point_id"),
        "path",
        "text",
        F.struct("path", "chunk", F.lit(run_id).alias("run_id")).alias("metadata"),
    )


def _coverage(reports: DataFrame, artefacts: dict[str, DataFrame]) -> DataFrame:
    """One row per key: number of reports `n`, and a flag for every kind of artefact.

    The reports are counted per key before the joins, so they are parsed once
    and a hot key is a single row in the joins.
    """
    both = reports.groupBy("dedup_key").agg(F.count(F.lit(1)).alias("n"))
    for kind, rows in artefacts.items():
        flagged = rows.select("dedup_key", F.lit(True).alias(kind))
        both = both.join(flagged, "dedup_key", "full")
    return both


def orphans(reports: DataFrame, artefacts: dict[str, DataFrame]) -> DataFrame:
    """`kind, dedup_key` of artefacts no report has."""
    keys = [rows.select(F.lit(kind).alias("kind"), "dedup_key") for kind, rows in artefacts.items()]
    known = reports.select("dedup_key").distinct()
    return functools.reduce(DataFrame.unionByName, keys).join(known, "dedup_key", "left_anti").select("kind", "dedup_key")


def enrichment_stats(reports: DataFrame, artefacts: dict[str, DataFrame], loud: tuple[str, ...] = ("conclusion",)) -> DataFrame:
    """Per kind of artefact: how many were loaded, how many reports they reach, how many reach none.

    None at all is an alarm for the `loud` kinds (conclusions are expected) and
    a normal state for the others (most incidents are never confirmed). With no
    reports there is no row.
    """

    def counts(kind: str) -> Column:
        has = F.coalesce(F.col(kind), F.lit(False))
        return F.struct(
            F.lit(kind).alias("kind"),
            F.count_if(has).alias("loaded"),
            F.coalesce(F.sum(F.when(has, F.coalesce("n", F.lit(0)))), F.lit(0)).alias("enriched"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.count_if(has & F.col("n").isNull()).alias("orphans"),
            ((F.count_if(has) == 0) & F.lit(kind in loud)).alias("alarm"),
        )

    kinds = F.array(*[counts(kind) for kind in artefacts])
    return _coverage(reports, artefacts).agg(kinds.alias("k")).select(F.inline("k")).filter("total > 0")
