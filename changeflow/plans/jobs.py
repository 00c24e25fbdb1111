"""The jobs, put together from the operators.

Each takes what would come from a command line or the environment as
arguments, does its work with Spark and returns its counts. The jobs on
changes are methods and functions already: `Ledger.merge`,
`feed.publish_changes`, `feed.hydrate`, `migrate.run_migrations`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.chunking import OVERLAP, SEPARATOR, SIZE
from changeflow.functions.vectors import Embedder
from changeflow.operators import artefacts as ar
from changeflow.operators import classify as cl
from changeflow.operators import points as pt
from changeflow.operators import reports as rp
from changeflow.operators.costs import result_attributes
from changeflow.operators.index import PointIndex
from changeflow.sources import documents as docs


def run_stamp(now: datetime) -> str:
    """Run id of a UTC time, to the second."""
    return now.strftime("%Y%m%dT%H%M%SZ")


def texts(spark: SparkSession, root: str, globs: list[str]) -> DataFrame:
    """`path, content` of the readable files."""
    return docs.scan_texts(spark, root, globs).filter("readable").drop("readable")


def enriched_reports(
    spark: SparkSession,
    root: str,
    run_id: str,
    globs: list[str] = docs.REPORT_GLOBS,
    conclusion_globs: list[str] = docs.CONCLUSION_GLOBS,
    confirmation_globs: list[str] = docs.CONFIRMATION_GLOBS,
) -> DataFrame:
    """Reports under a root with the payload their artefacts give them."""
    return pt.enrich(
        rp.reports(texts(spark, root, globs)),
        ar.conclusions(texts(spark, root, conclusion_globs)),
        ar.confirmations(texts(spark, root, confirmation_globs)),
        run_id,
    )


def index_reports(
    spark: SparkSession,
    root: str,
    index: PointIndex,
    now: datetime,
    build_points: Callable[[DataFrame], DataFrame] = pt.points_whole,
    embed: Embedder | None = None,
    **globs: list[str],
) -> dict[str, int]:
    """Refresh a collection from the reports: whole ones, or `points_sections`."""
    run_id = run_stamp(now)
    points = build_points(enriched_reports(spark, root, run_id, **globs))
    return index.refresh(points, run_id, now, embed=embed)


def index_chunks(
    spark: SparkSession,
    root: str,
    index: PointIndex,
    now: datetime,
    globs: list[str] | None = None,
    size: int = SIZE,
    overlap: int = OVERLAP,
    separator: str = SEPARATOR,
    embed: Embedder | None = None,
) -> dict[str, int]:
    """Refresh a collection from chunked documents. An empty source always fails."""
    run_id = run_stamp(now)
    chunked = pt.chunk_rows(texts(spark, root, globs or ["**/*.md"]), "content", size, overlap, separator)
    points = pt.chunk_points(chunked, run_id)
    return index.refresh(points, run_id, now, allow_empty_first_run=False, embed=embed)


def classify(
    reports: DataFrame,
    existing: DataFrame,
    out: str,
    scope: cl.Scope = cl.MISSING,
    scorer: cl.Scorer = cl.rule_scorer,
) -> dict[str, int]:
    """Score what the scope asks for and store the artefacts under `out`.

    `existing` holds the conclusion artefacts so far (`path, content`). Scores
    are written once, to `<out>/scored`, and read back for both the new
    artefacts (`<out>/conclusions`, all of them) and the counts, so no report is
    scored twice. Fails, after writing, where `check_run` says so.
    """
    spark = reports.sparkSession
    cl.score(cl.select_reports(reports, existing, scope), scorer).write.parquet(f"{out}/scored")
    scored = spark.read.parquet(f"{out}/scored")
    counts = cl.summary(reports, scored).first().asDict()
    cl.write_conclusions(existing, scored).write.parquet(f"{out}/conclusions")
    selected = counts["done"] + counts["failed"]
    cl.check_run(selected + counts["skipped"], selected, counts["done"], counts["failed"], scope)
    return counts


def call_attributes(reports: DataFrame, scored: DataFrame, attributes: Column) -> DataFrame:
    """Trace attributes of the scored reports, with what each result adds.

    Report and result meet by the path of the conclusion: a key may have many
    reports, a path has one.
    """
    own = reports.select("dedup_key", ar.checked_conclusion_path(F.col("path")).alias("path"), attributes.alias("attributes"))
    return own.join(scored.select("path", result_attributes().alias("result")), "path").select(
        "dedup_key", F.map_concat("attributes", "result").alias("attributes")
    )
