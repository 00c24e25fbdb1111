"""Quality by compression: how much better good text's dictionary compresses a text than bad text's."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import extended, guarded, labelled_sample

PER_CLASS = 3000  # labelled texts of a class that are read for fitting, at most
MAX_CHARS = 30_000  # longer texts are not fitted on (all texts are scored)
DICTIONARY = 112_640  # bytes of a dictionary
LEVEL = 3
SCORED = "score double, predicted int, good_bytes long, bad_bytes long"


@dataclass
class CompressionModel:
    """Two dictionaries and the logistic curve that turns compressed sizes into a probability."""

    good: bytes
    bad: bytes
    weights: list[float]
    prior: float  # the score where there is nothing to compare: empty texts, or no labels of both kinds

    def compressors(self):
        return [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False)
            for d in (self.good, self.bad)
        ]

    def score(self, text: str | None, compressors) -> tuple[float, int, int]:
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data or not self.good:
            return self.prior, 0, 0
        good, bad = (len(c.compress(data)) for c in compressors)
        z = float(np.dot(self.weights, features(len(data), good, bad)))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40)))), good, bad


def features(size: int, good: int, bad: int) -> list[float]:
    """What the calibration sees: the normalised size difference, and how compressible the text is at all.

    The difference is positive where the good dictionary does better. Two
    steps of the compressed share let text that repeats itself, which both
    dictionaries shrink to nothing, count as such.
    """
    share = min(good, bad) / size
    d = (bad - good) / (bad + good)
    return [1.0, 10 * d, share, np.log(share), float(share < 0.2), np.log(size) / 4, d * np.log(size)]


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; too few texts to train on serve as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:DICTIONARY] or b" "


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Logistic regression by damped Newton steps, slightly regularised. `weight` is the weight of a row."""
    weights, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge @ weights
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, gradient)
        weights -= step / max(1.0, float(np.abs(step).max()) / 4)
        if np.abs(step).max() < 1e-8:
            break
    return weights.tolist()


def fit_texts(sample: list[tuple[str, int]], good_share: float | None = None) -> CompressionModel:
    """Dictionaries from half of the sample, calibration on the other half.

    `good_share` is the share of good rows among all labelled ones; the
    calibration weighs its rows to match it.
    """
    sample = [(t.encode("utf-8", "surrogatepass"), y) for t, y in sample if t]
    ones = sum(y for _, y in sample)
    zeros = len(sample) - ones
    if not ones or not zeros:
        return CompressionModel(b"", b"", [], 1.0 if not zeros else 0.0)
    by_class = {y: [t for t, k in sample if k == y] for y in (0, 1)}
    good, bad = (_dictionary(by_class[y][::2]) for y in (1, 0))
    model = CompressionModel(good, bad, [], ones / len(sample) if good_share is None else good_share)
    kept = [(t, y) for y in (0, 1) for t in by_class[y][1::2] or by_class[y]]
    tools = model.compressors()
    x = np.array([features(len(t), *(len(c.compress(t)) for c in tools)) for t, _ in kept])
    y = np.array([y for _, y in kept], float)
    weight = np.where(y > 0, model.prior / y.mean(), (1 - model.prior) / (1 - y.mean()))
    model.weights = _calibrate(x, y, weight)
    return model


def fit(docs: DataFrame, labels: DataFrame, train: Column, per_class: int = PER_CLASS) -> CompressionModel:
    """Fit on at most `per_class` labelled texts of each class, chosen by a hash of the id.

    The share of good labels is counted over all training labels. Without
    labels of both classes nothing can be learned: every text then scores as
    the only class seen, and 1 (good) where there is no label.
    """
    sample = labelled_sample(docs, labels, "quality", train, per_class, per_class, MAX_CHARS)
    known = F.col("doc_id").isNotNull() & train & F.col("quality").isin(0, 1)
    share = labels.filter(known).agg(F.avg(F.col("quality").cast("double"))).first()[0]
    return fit_texts(sample, share)


def score(docs: DataFrame, model: CompressionModel, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1, higher is better), `predicted` and the two compressed sizes.

    Whole texts are compressed. Null and empty texts score the model's prior.
    Every row gives a row; existing columns of these names are replaced. One
    pass, no shuffle: the model is a few hundred kilobytes, whatever the input.
    """
    names = [c.split()[0] for c in SCORED.split(", ")]
    rest = docs.drop(*names)
    schema = extended(rest, SCORED)
    at = rest.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors() if model.good else None
        for batch in batches:
            found = [model.score(t.as_py(), tools) for t in batch.column(at)]
            p, good, bad = (list(c) for c in zip(*found, strict=True)) if found else ([], [], [])
            extra = [
                pa.array(p, pa.float64()),
                pa.array([int(x >= 0.5) for x in p], pa.int32()),
                pa.array(good, pa.int64()),
                pa.array(bad, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *names])

    return rest.mapInArrow(run, schema)


def reject(docs: DataFrame, labels: DataFrame, train: Column | None = None) -> DataFrame:
    """The documents that score at least 0.5, with the columns they came with."""
    model = fit(docs, labels, F.lit(True) if train is None else train)
    safe, back = guarded(docs)
    return back(score(safe, model).filter("predicted = 1"))
