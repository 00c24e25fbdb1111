"""Score the reports that still lack a conclusion."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import frontmatter as fm
from changeflow.functions.sections import blocks, headings, sections
from changeflow.functions.text import built_once, heading_name, let, strip, unpacked
from changeflow.operators.artefacts import (
    DIAGNOSED,
    INCONCLUSIVE,
    VERDICT_MAX_CHARS,
    checked_conclusion_path,
    conclusion_markdown,
    conclusion_problem,
    one_per_key,
)
from changeflow.operators.index import upsert

SLICE = 512  # reports that a hook's task takes up at a time
FIELDS = ["outcome", "verdict", "confidence", "reason", "rationale"]

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Scope:
    """Which reports a run scores: those without a conclusion, or all that match.

    `redo` takes reports with a conclusion as well; naming a key or a namespace
    implies it. Both may be named, then both must match.
    """

    redo: bool = False
    dedup_key: str | None = None
    namespace: str | None = None

    @property
    def named(self) -> bool:
        return self.dedup_key is not None or self.namespace is not None

    def matches(self) -> Column:
        own, space = F.col("dedup_key"), fm.text(fm.value(F.col("fm"), "namespace"))
        wanted = [(own, self.dedup_key), (space, self.namespace)]
        return reduce(lambda a, b: a & b, [c == v for c, v in wanted if v is not None], F.lit(True))


MISSING, ALL = Scope(), Scope(redo=True)


def select_reports(reports: DataFrame, existing: DataFrame, scope: Scope = MISSING) -> DataFrame:
    """The reports to score.

    By default those whose conclusion file does not exist. Only the path
    counts, so a malformed conclusion is not redone, while a failed report,
    which wrote nothing, is. `existing` has the `path` of every conclusion.
    """
    if scope.redo or scope.named:
        return reports.filter(scope.matches())
    located = reports.withColumn("_sibling", checked_conclusion_path(F.col("path")))
    done = existing.select(F.col("path").alias("_sibling"))
    return located.join(done, "_sibling", "left_anti").drop("_sibling")


@built_once
def _confidence_line(body: str) -> Column:
    """First word of the first line below the last heading named `confianca`, in lower case."""

    def below(bs: Column, heads: Column) -> Column:
        own = F.filter(heads, lambda h: heading_name(h["name"]) == "confianca")
        at = F.try_element_at(own, F.lit(-1))["at"]
        following = F.filter(F.slice(bs, at + 2, F.size(bs)), lambda b: strip(b) != "")
        return F.regexp_extract(F.lower(F.get(following, F.lit(0))), r"^[^\n]*?(\p{L}+)", 1)

    return let(blocks(F.col(body)), lambda bs: let(headings(bs), lambda heads: below(bs, heads)))


# Stated confidence -> level.
CONFIDENCE_WORDS = {"alta": "high", "média": "medium", "baixa": "low"}


def rule_scorer(reports: DataFrame) -> DataFrame:
    """Baseline without a model: reads what the report itself states.

    A cause section makes it diagnosed, with that section as verdict and the
    stated confidence, or low. Without one it is inconclusive. A section too
    long for a verdict is not cut: validation marks the report as failed.
    """
    cause = F.get(F.filter(sections("body"), lambda s: s["section"] == "cause"), F.lit(0))["text"]
    words = F.create_map(*[F.lit(x) for pair in CONFIDENCE_WORDS.items() for x in pair])
    stated = F.coalesce(F.try_element_at(words, _confidence_line("body")), F.lit("low"))
    seen = F.struct(cause.alias("_cause"), stated.alias("_stated"))
    found = F.col("_cause").isNotNull()
    return reports.select("*", unpacked(seen)).select(
        *reports.columns,
        F.when(found, DIAGNOSED).otherwise(INCONCLUSIVE).alias("outcome"),
        strip(F.col("_cause")).alias("verdict"),
        F.when(found, F.col("_stated")).alias("confidence"),
        F.when(~found, "no cause section").alias("reason"),
        F.when(found, "cause section present").otherwise("no cause section").alias("rationale"),
        F.lit(None).cast("string").alias("error"),
    )


def batch_scorer(
    factory: Callable[[], Callable[[list[str]], list[dict]]], retries: int = 2, batch: int = 4
) -> Scorer:
    """A scorer around a batch function (a model client, say).

    `factory` runs once per task. Its function takes report bodies and returns
    one dict of conclusion fields for each; rows that are no valid conclusion
    are asked again, up to `retries` times. A row that still fails, or whose
    call raised, keeps its error and no conclusion.
    """

    def problem(fields: dict) -> str | None:
        outcome = fields.get("outcome")
        if outcome not in (DIAGNOSED, INCONCLUSIVE):
            return "unknown outcome"
        text = fields.get("verdict" if outcome == DIAGNOSED else "reason")
        if not isinstance(text, str) or len(text) > VERDICT_MAX_CHARS:
            return "bad verdict" if outcome == DIAGNOSED else "bad reason"
        if outcome == DIAGNOSED and fields.get("confidence") not in CONFIDENCE_WORDS.values():
            return "bad confidence"
        if not isinstance(fields.get("rationale"), str):
            return "bad rationale"
        return None

    def score(reports: DataFrame) -> DataFrame:
        names = ["dedup_key", "path", "body", *FIELDS, "error"]
        step = batch * max(1, SLICE // batch)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ask = factory()
            # A slice at a time: Python holds its bodies and answers only, however many rows a batch has.
            for part in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
                bodies = part.column(2).to_pylist()
                answers: list[dict] = [{} for _ in bodies]
                errors: list[str | None] = ["not scored"] * len(bodies)
                for _ in range(retries + 1):
                    todo = [i for i, e in enumerate(errors) if e is not None]
                    for start in range(0, len(todo), batch):
                        asked = todo[start : start + batch]
                        try:
                            got = ask([bodies[i] for i in asked])
                        except Exception as e:  # one bad call must not fail the others
                            got, reason = [{}] * len(asked), f"call failed: {e}"
                        else:
                            reason = None
                        for i, fields in zip(asked, got):
                            answers[i], errors[i] = fields, reason or problem(fields)
                told = [[a.get(name) if e is None else None for a, e in zip(answers, errors)] for name in FIELDS]
                yield pa.record_batch([*part.columns, *(pa.array(c, pa.string()) for c in (*told, errors))], names)

        slim = reports.select("dedup_key", "path", "body")
        scored = slim.mapInArrow(run, ", ".join(f"{c} string" for c in names))
        return scored

    return score


def score(reports: DataFrame, scorer: Scorer = rule_scorer) -> DataFrame:
    """`dedup_key, path` of the conclusion, its fields, and `error` for a failed row."""
    problem = conclusion_problem(F.col("outcome"), F.col("verdict"), F.col("confidence"), F.col("reason"))
    return scorer(reports).select(
        "dedup_key",
        checked_conclusion_path(F.col("path")).alias("path"),
        *FIELDS,
        F.coalesce("error", problem).alias("error"),
    )


def succeeded(scored: DataFrame) -> DataFrame:
    return scored.filter("error is null").drop("error")


def write_conclusions(existing: DataFrame, scored: DataFrame) -> DataFrame:
    """The conclusion artefacts after this run: `path, content`, same path replaced.

    A failed row writes nothing and is picked up again by the next run.
    """
    fresh = succeeded(scored)
    fresh = one_per_key(fresh.select("path", "dedup_key", conclusion_markdown(fresh).alias("content")), "path", "dedup_key")
    return upsert(existing.select("path", "content"), fresh.select("path", "content"), "path")


def summary(reports: DataFrame, scored: DataFrame) -> DataFrame:
    """`done, skipped, failed` of a run over all reports."""
    zero = F.lit(0)
    seen = reports.select(F.lit(1).alias("total"), zero.alias("done"), zero.alias("failed"))
    ok = F.col("error").isNull()
    tried = scored.select(
        zero.alias("total"), ok.cast("int").alias("done"), (~ok).cast("int").alias("failed")
    )
    total, done, failed = (F.coalesce(F.sum(c), zero) for c in ("total", "done", "failed"))
    return seen.unionByName(tried).agg(
        done.alias("done"), (total - done - failed).alias("skipped"), failed.alias("failed")
    )


def check_run(total: int, selected: int, done: int, failed: int, scope: Scope) -> None:
    """Fail an empty corpus, a filter that matches nothing, and a run in which all failed."""
    if total == 0:
        raise RuntimeError("0 reports: is the source empty?")
    if scope.named and selected == 0:
        raise RuntimeError(f"no report matches {scope}")
    if failed and not done:
        raise RuntimeError(f"all {failed} reports failed")
