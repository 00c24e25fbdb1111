"""Conclusions and confirmations: the artefacts that sit beside a report.

A conclusion is either *diagnosed* (verdict, confidence, rationale) or
*inconclusive* (reason, rationale). As a row it has all of these columns, and
`conclusion_problem` says why a row is not a valid conclusion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import frontmatter as fm
from changeflow.functions.text import WHITESPACE, lstrip, quote, strip
from changeflow.operators.reports import parsed

# Fixed values of the artefact format.
SCHEMA_VERSION = 1
VERDICT_MAX_CHARS = 300
RATIONALE_HEADING = "## Rationale"
DIAGNOSED, INCONCLUSIVE = "diagnosed", "inconclusive"
CONFIDENCE = ["high", "medium", "low"]
CONFIRMATION = ["confirmed", "refuted"]
REPORT_PREFIX, CONCLUSION_PREFIX = "triage/", "conclusions/"

NO_KEY = "no dedup_key"


def conclusion_problem(outcome: Column, verdict: Column, confidence: Column, reason: Column) -> Column:
    """Why these fields are no conclusion; null when they are one."""

    def bad_text(text: Column) -> Column:
        return text.isNull() | (F.length(text) > VERDICT_MAX_CHARS)

    known = F.coalesce(outcome.isin(DIAGNOSED, INCONCLUSIVE), F.lit(False))
    return (
        F.when(~known, "unknown outcome")
        .when((outcome == DIAGNOSED) & bad_text(verdict), "bad verdict")
        .when((outcome == DIAGNOSED) & ~F.coalesce(confidence.isin(*CONFIDENCE), F.lit(False)), "bad confidence")
        .when((outcome == INCONCLUSIVE) & bad_text(reason), "bad reason")
    )


def _scalar(key: str, default: str) -> Column:
    """Text of a key; the default where the key is absent; null for a list."""
    entry = fm.value(F.col("fm"), key)
    return F.when(entry.isNull(), F.lit(default)).otherwise(fm.text(entry))


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("dedup_key", F.nullif(fm.text(fm.value(F.col("fm"), "dedup_key")), F.lit("")))


def read_conclusions(raw: DataFrame) -> DataFrame:
    """Conclusion artefacts as rows: fields, rationale and `skip_reason`."""
    rationale = F.when(
        F.startswith(lstrip(F.col("body")), F.lit(RATIONALE_HEADING)),
        F.substring(lstrip(F.col("body")), F.lit(len(RATIONALE_HEADING) + 1), F.length("body")),
    ).otherwise(F.col("body"))
    docs = _with_key(parsed(raw)).select(
        "dedup_key",
        "path",
        _scalar("outcome", "").alias("outcome"),
        _scalar("verdict", "").alias("verdict"),
        _scalar("confidence", "low").alias("confidence"),
        _scalar("reason", "").alias("reason"),
        strip(rationale).alias("rationale"),
    )
    problem = conclusion_problem(F.col("outcome"), F.col("verdict"), F.col("confidence"), F.col("reason"))
    return _only_own_fields(
        docs.withColumn("skip_reason", F.when(F.col("dedup_key").isNull(), NO_KEY).otherwise(problem))
    )


def _only_own_fields(conclusions: DataFrame) -> DataFrame:
    """No confidence on an inconclusive row, no reason on a diagnosed one."""
    diagnosed = F.col("outcome") == DIAGNOSED
    return conclusions.withColumns(
        {
            "verdict": F.when(diagnosed, F.col("verdict")),
            "confidence": F.when(diagnosed, F.col("confidence")),
            "reason": F.when(F.col("outcome") == INCONCLUSIVE, F.col("reason")),
        }
    )


def one_per_key(rows: DataFrame, key: str = "dedup_key", order: str = "path") -> DataFrame:
    """Greatest `order` wins. Combines before the shuffle, so hot keys stay cheap."""
    rest = [c for c in rows.columns if c != key]
    best = F.max_by(F.struct(*rest), F.col(order)).alias("r")
    return rows.groupBy(key).agg(best).select(key, "r.*")


def conclusions(raw: DataFrame) -> DataFrame:
    """Payload fields of the valid conclusions, one per key.

    Validity comes first: a bad file never hides a good one of the same key.
    """
    good = read_conclusions(raw).filter("skip_reason is null")
    return one_per_key(good.select("dedup_key", "path", "outcome", "verdict", "confidence")).drop("path")


def read_confirmations(raw: DataFrame) -> DataFrame:
    value = fm.text(fm.value(F.col("fm"), "confirmation"))
    docs = _with_key(parsed(raw)).select("dedup_key", "path", value.alias("confirmation"))
    known = F.coalesce(F.col("confirmation").isin(*CONFIRMATION), F.lit(False))
    return docs.withColumn(
        "skip_reason",
        F.when(F.col("dedup_key").isNull(), NO_KEY).when(~known, "bad confirmation"),
    )


def confirmations(raw: DataFrame) -> DataFrame:
    """Valid human confirmations, one per key. Other fields stay in the artefact."""
    good = read_confirmations(raw).filter("skip_reason is null").drop("skip_reason")
    return one_per_key(good).drop("path")


def conclusion_markdown(rows: DataFrame) -> Column:
    """The artefact text of a conclusion row."""
    diagnosed = F.col("outcome") == DIAGNOSED
    finding = F.when(
        diagnosed,
        F.concat(F.lit("verdict: "), quote(F.col("verdict")), F.lit("\nconfidence: "), F.col("confidence")),
    ).otherwise(F.concat(F.lit("reason: "), quote(F.col("reason"))))
    return F.concat_ws(
        "\n",
        F.lit("---"),
        F.lit(f"schema: {SCHEMA_VERSION}"),
        F.concat(F.lit("dedup_key: "), quote(F.col("dedup_key"))),
        F.concat(F.lit("outcome: "), F.col("outcome")),
        finding,
        F.lit("---"),
        F.lit(""),
        F.lit(RATIONALE_HEADING),
        F.lit(""),
        F.btrim(F.col("rationale"), F.lit(WHITESPACE)),
        F.lit(""),
    )


def conclusion_path(path: Column) -> Column:
    """Where the conclusion of a report lives; null for a path outside the reports."""
    return F.when(
        F.startswith(path, F.lit(REPORT_PREFIX)),
        F.concat(F.lit(CONCLUSION_PREFIX), F.substring(path, F.lit(len(REPORT_PREFIX) + 1), F.length(path))),
    )


def checked_conclusion_path(path: Column) -> Column:
    """As `conclusion_path`, but a path outside the reports fails the job."""
    return F.coalesce(
        conclusion_path(path), F.raise_error(F.concat(F.lit("report outside triage/: "), path))
    )
