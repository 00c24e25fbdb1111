"""Trace attributes of a classification run and what its calls cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import frontmatter as fm

# Names under which a tracing backend is to find the attributes; the two
# prefixes are the contract with it and therefore arguments below.
TRACE_PREFIX, DOMAIN_PREFIX = "trace.", "incident."


def trace_attributes(run_id: str, trace: str = TRACE_PREFIX, domain: str = DOMAIN_PREFIX) -> Column:
    """Attributes of a report's trace, as a map.

    The session is the report's key, so all calls for an incident add up; the
    trace name carries the alert names and stays low in cardinality.
    """

    def joined(key: str) -> Column:
        return F.coalesce(F.array_join(fm.value(F.col("fm"), key)["vals"], ","), F.lit(""))

    alert = joined("alertnames")
    name = F.when(alert != "", F.concat(F.lit("classify:"), alert)).otherwise("classify")
    return F.create_map(
        F.lit(f"{trace}session.id"), F.col("dedup_key"),
        F.lit(f"{trace}trace.name"), name,
        F.lit(f"{domain}alertname"), alert,
        F.lit(f"{domain}namespace"), joined("namespace"),
        F.lit(f"{domain}run_id"), F.lit(run_id),
    )


def result_attributes(domain: str = DOMAIN_PREFIX) -> Column:
    """What a scored report adds to its trace."""
    return F.map_filter(
        F.create_map(
            F.lit(f"{domain}outcome"), F.col("outcome"), F.lit(f"{domain}confidence"), F.col("confidence")
        ),
        lambda _, v: v.isNotNull(),
    )


def domain_attributes(attributes: Column, prefixes: tuple[str, ...] = (TRACE_PREFIX, DOMAIN_PREFIX)) -> Column:
    """Only attributes under these prefixes, and only with a value."""

    def kept(key: Column, value: Column) -> Column:
        known = F.lit(False)
        for prefix in prefixes:
            known = known | F.startswith(key, F.lit(prefix))
        return known & (value != "")

    return F.map_filter(attributes, kept)


def attribute_rows(rows: DataFrame, attributes: Column, id_column: str) -> DataFrame:
    return rows.select(id_column, F.explode(attributes).alias("attr", "value"))


def call_cost(raw: Column) -> Column:
    """Cost from a header text; empty or malformed reads as no cost."""
    return F.nullif(F.trim(raw), F.lit("")).try_cast("double")


def cost_per_session(calls: DataFrame) -> DataFrame:
    cost = call_cost(F.col("raw_cost"))
    return calls.groupBy("session_id").agg(
        F.round(F.sum(cost), 4).alias("cost"),
        F.count(F.lit(1)).alias("calls"),
        F.count_if(cost.isNull()).alias("unpriced"),
    )
