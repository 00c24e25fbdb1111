"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A sentence is toxic with p = sigmoid(bias + sum of the weights of its distinct
words and word beginnings); a document with 1 - product of (1 - p) over its sentences (noisy-or).
The weights are fitted on document labels; sentences with a high p are where
the offence is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import extended, guarded, labelled_sample

TOXIC, CLEAN = 2000, 4000  # labelled texts read for fitting, at most
MAX_CHARS = 30_000  # longer texts are not fitted on (all texts are scored)
LEAST_DOCS = 3  # training documents a feature must occur in to get a weight
LEAST_Z = 4.0  # standard deviations by which toxic documents must hold it more often than their share
STEPS = 150

SENTENCES = re.compile(r"[^.!?\n]+")
WORDS = re.compile(r"\w+")
STEMS = (4, 5, 6)  # letters of the word beginnings that are features beside the words: offences are inflected


def features(sentence: str) -> set[str]:
    """Distinct words of a lower-cased sentence, and their beginnings marked with a hyphen."""
    words = set(WORDS.findall(sentence))
    return words.union(*({w[:n] + "-" for w in words if len(w) > n} for n in STEMS))


@dataclass
class NoisyOr:
    weights: dict[str, float]
    bias: float
    constant: float | None = None  # the score of every text where nothing could be learned

    def sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, p) of every sentence with a weighted word. All others are no instances and have none."""
        get, lowered = self.weights.get, text.lower()
        if len(lowered) != len(text):  # a letter grew when lowered: offsets must stay those of the text
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        for m in SENTENCES.finditer(lowered):
            found = features(m[0]) & self.weights.keys()
            if found:
                z = self.bias + sum(sorted(map(get, found)))
                yield m.start(), m.end(), float(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))

    def __post_init__(self):
        self.heads = {w.removesuffix("-")[: STEMS[0]] for w in self.weights}

    def score(self, text: str | None) -> float:
        """1 - product of (1 - p) over the sentences. Those without a weighted word are left out, as in the fit."""
        if self.constant is not None:
            return self.constant
        # Most texts hold no word that starts like a weighted one.
        if not text or self.heads.isdisjoint([w[: STEMS[0]] for w in WORDS.findall(text.lower())]):
            return 0.0
        clean = 0.0
        for _, _, p in self.sentences(text):
            clean += np.log1p(-min(p, 1 - 1e-12))
        return max(0.0, float(-np.expm1(clean)))


def fit_texts(sample: list[tuple[str, int]]) -> NoisyOr:
    """Full-batch gradient ascent (Adam) on the log likelihood of the document labels."""
    ones = sum(y for _, y in sample)
    if not ones or ones == len(sample):
        return NoisyOr({}, 0.0, 1.0 if ones else 0.0)
    seen: Counter[str] = Counter()
    toxic: Counter[str] = Counter()
    for text, y in sample:
        found = features(text.lower())
        seen.update(found)
        if y:
            toxic.update(found)
    share = ones / len(sample)
    # Only what is more frequent in toxic documents beyond chance can point at a toxic sentence.
    beyond = {w: share * n + LEAST_Z * np.sqrt(n * share * (1 - share)) for w, n in seen.items() if n >= LEAST_DOCS}
    vocabulary = sorted(w for w, least in beyond.items() if toxic[w] >= least)
    index = {w: i for i, w in enumerate(vocabulary)}
    word, owner, document = [], [], []
    for d, (text, _) in enumerate(sample):
        for sentence in SENTENCES.findall(text.lower()):
            found = sorted(index[w] for w in features(sentence) if w in index)
            if found:
                word += found
                owner += [len(document)] * len(found)
                document.append(d)
    if not document:
        return NoisyOr({}, 0.0, share)
    word, owner, document = (np.array(x, np.int64) for x in (word, owner, document))
    y = np.array([k for _, k in sample], float)
    n = len(vocabulary)
    theta, first, second = np.append(np.zeros(n), -4.0), np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, STEPS + 1):
        z = theta[-1] + np.bincount(owner, theta[word], len(document))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-12)), len(sample))
        bag = np.clip(-np.expm1(clean), 1e-9, 1 - 1e-12)
        pull = np.where(y[document] > 0, p * (1 - bag[document]) / bag[document], -p)
        gradient = np.append(np.bincount(word, pull[owner], n), pull.sum()) / len(sample)
        gradient[:n] -= 2e-5 * theta[:n]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return NoisyOr(dict(zip(vocabulary, theta[:-1].tolist(), strict=True)), float(theta[-1]))


def fit(docs: DataFrame, labels: DataFrame, train: Column, toxic: int = TOXIC, clean: int = CLEAN) -> NoisyOr:
    """Fit on at most `toxic` + `clean` labelled texts, chosen by a hash of the id.

    Without labels of both classes nothing can be learned: every text then
    scores as the only class seen, and 0 (harmless) where there is no label.
    """
    return fit_texts(labelled_sample(docs, labels, "toxic", train, clean, toxic, MAX_CHARS))


def score(docs: DataFrame, model: NoisyOr, text: str = "text", spans: bool = False) -> DataFrame:
    """`docs` with `score`, `predicted`, and with `spans` also `offending`.

    `offending` lists the sentences with p >= 0.5 as (start, end, p), offsets
    in characters of the text as it is. Whole texts are read; null and empty
    ones score 0. Every row gives a row; existing columns of these names are
    replaced. One pass, no shuffle.
    """
    rest = docs.drop("score", "predicted", "offending")
    ddl = "score double, predicted int"
    if spans:
        ddl += ", offending array<struct<start:long,end:long,p:double>>"
    schema = extended(rest, ddl)
    names, at = schema.fieldNames()[len(rest.columns) :], rest.columns.index(text)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            p = [model.score(t) for t in texts]
            extra = [pa.array(p, pa.float64()), pa.array([int(x >= 0.5) for x in p], pa.int32())]
            if spans:
                where = [
                    [{"start": a, "end": b, "p": q} for a, b, q in model.sentences(t or "") if q >= 0.5] for t in texts
                ]
                extra.append(pa.array(where, span))
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *names])

    return rest.mapInArrow(run, schema)


def reject(docs: DataFrame, labels: DataFrame, train: Column | None = None) -> DataFrame:
    """The documents that score under 0.5, with the columns they came with."""
    model = fit(docs, labels, F.lit(True) if train is None else train)
    safe, back = guarded(docs)
    return back(score(safe, model).filter("predicted = 0"))
