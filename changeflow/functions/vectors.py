"""Text to vector: the hook for an embedding model, and a default without one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.ids import digest_int
from changeflow.functions.text import let

DIM = 64

# Texts that Python takes apart at a time; words whose bucket a task remembers, and the longest of them in bytes.
SLICE = 512
KNOWN_WORDS, KNOWN_BYTES = 200_000, 64

# A factory called once per task; what it returns maps a list of texts to a
# (len, dim) matrix. Loading a model belongs in the factory.
Embedder = Callable[[], Callable[[list[str]], np.ndarray]]


def word_buckets(text: Column, dim: int = DIM) -> Column:
    """`array<int>` with one signed bucket, +-(1..dim), per word of the text."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def bucket(digest: Column) -> Column:
        # 31 bits pick the bucket, one bit its sign.
        index = (F.shiftright(digest, 1) % dim + 1).cast("int")
        return F.when(digest % 2 == 0, index).otherwise(-index)

    return F.transform(words, lambda w: let(digest_int(w), bucket))


def hashed_vectors(df: DataFrame, text: str = "text", into: str = "vector", dim: int = DIM) -> DataFrame:
    """Signed feature hashing of words, scaled to unit length (all zero if empty).

    The buckets are those of `word_buckets`. Most words come again and again, so a task keeps those it has hashed, as
    many as `KNOWN_WORDS`; a slice of its texts at a time is taken apart, one matrix each.
    """

    @F.pandas_udf("array<float>")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[bytes, int] = {}

        def bucket(word: bytes) -> int:
            digest = int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:4], "big")
            signed = ((digest >> 1) % dim + 1) * (1 if digest % 2 == 0 else -1)
            if len(word) <= KNOWN_BYTES:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                known[word] = signed
            return signed

        for batch in batches:
            for start in range(0, len(batch), SLICE):
                # Bytes are split at ASCII white space, as \\s does.
                words = [(t or b"").split() for t in batch.iloc[start : start + SLICE]]
                n = len(words)
                sizes = np.fromiter(map(len, words), np.int64, n)
                flat = np.fromiter((known.get(w) or bucket(w) for ws in words for w in ws), np.int64, int(sizes.sum()))
                cells = np.repeat(np.arange(n), sizes) * dim + np.abs(flat) - 1
                matrix = np.bincount(cells, weights=np.sign(flat), minlength=n * dim).reshape(-1, dim)
                norm = np.linalg.norm(matrix, axis=1, keepdims=True)
                matrix = np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)
                yield pd.Series(list(matrix.astype(np.float32)))

    return df.withColumn(into, counted(F.lower(F.col(text)).cast("binary")))


def with_vectors(
    df: DataFrame, embed: Embedder | None = None, text: str = "text", into: str = "vector", batch: int = 8, dim: int = DIM
) -> DataFrame:
    """Adds a vector column: of the given model, or of `dim` hashed words by default."""
    if embed is None:
        return hashed_vectors(df, text, into, dim)

    @F.arrow_udf("array<float>")
    def embedded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, step = embed(), batch * max(1, SLICE // batch)
        for texts in batches:
            # Python holds the texts and vectors of a slice only, however many rows the batch has.
            for start in range(0, len(texts), step):
                values = texts.slice(start, step).to_pylist()
                parts = [np.asarray(model(values[i : i + batch]), np.float32) for i in range(0, len(values), batch)]
                yield pa.array([row for part in parts for row in part], pa.list_(pa.float32()))

    return df.withColumn(into, embedded(F.col(text)))
