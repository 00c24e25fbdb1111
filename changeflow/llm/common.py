"""What the operators share: tables, folds, word bytes and hashes, bounded labelled samples."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.session import work_dir

#: A-Z to a-z, every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extended(frame: DataFrame, ddl: str) -> T.StructType:
    """The schema of `frame` with further columns behind it."""
    return T.StructType(frame.schema.fields + T.StructType.fromDDL(ddl).fields)


def guarded(docs: DataFrame, text: str = "text") -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with names that no added column can clash with, and the way back to its own columns and names."""
    safe = [c if c == text else f"_{i}" for i, c in enumerate(docs.columns)]
    names = docs.columns
    return docs.toDF(*safe), lambda out: out.select(*[F.col(s).alias(n) for s, n in zip(safe, names, strict=True)])


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`; a null key counts as the empty text."""
    return F.coalesce(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(0)) % modulus


def words(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII white space (space, tab to carriage return)."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def hashes(tokens: list[bytes]) -> np.ndarray:
    """One 64-bit hash per token."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole word (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: later steps neither repeat it nor depend on an executor."""
    path = work_dir(frame.sparkSession, name)
    schema = frame.schema
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(schema).parquet(path)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, zeros: int, ones: int, max_chars: int
) -> list[tuple[str, int]]:
    """At most `zeros` + `ones` labelled texts, the same ones on every run.

    `train` is a condition on the labels' `doc_id`. A repeated label row
    counts once, of contradicting ones the greater label holds. Rows are taken
    in the order of a hash of the id; texts longer than `max_chars` characters
    are left out of the sample, so it is bounded in bytes as well.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & train & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    short = docs.filter(F.coalesce(F.length("text"), F.lit(0)) <= max_chars).select("doc_id")
    known = known.join(short, "doc_id", "left_semi")  # ids are drawn among texts that may be taken
    ids = None
    for y, n in ((0, zeros), (1, ones)):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        ids = part if ids is None else ids.unionByName(part)
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .filter(F.length("text") <= max_chars)
        .join(F.broadcast(ids), "doc_id")  # at most zeros + ones ids
        .orderBy(F.xxhash64("doc_id"), F.xxhash64("text"))
        .limit(zeros + ones)
    )
    return [(r["text"], r["y"]) for r in rows.select("text", "y").collect()]
