"""Language-model scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark.

Counts are merged in shards by the hash of a pair's first word and written as
sorted hash arrays. Workers map the arrays into memory and search them with
sorted batches of hashes, so scoring holds no model in its own memory.
"""

from __future__ import annotations

import math
import os
import shutil
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import extended, hashes, mix, words
from changeflow.session import work_dir

BATCH_CHARS = 8_000_000  # characters of texts that are counted or scored together
SHARD_CHARS = 40_000_000  # characters of training text for one shard of the model
NARROW = 1 << 32  # counts below this are stored in 32 bits; a shard with a greater one keeps all of its own in 64
BEGIN, END = np.uint64(0x5BD1E995A3C59AC3), np.uint64(0xC6A4A7935BD1E995)  # the hashes of begin and end
SCORED = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) ^ second)


def _shard(key: np.ndarray, shards: int) -> np.ndarray:
    return (mix(key ^ np.uint64(0xA5A5A5A5)) % np.uint64(shards)).astype(np.int64)


def _sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end behind each text, the word before each (or begin), and the text's number."""
    parts, sizes = [], []
    for text in texts:
        h = hashes(words(text))
        parts += [h, np.array([END])]
        sizes.append(len(h) + 1)
    second = np.concatenate(parts)
    first = np.append(BEGIN, second[:-1])
    starts = np.cumsum([0, *sizes[:-1]])
    first[starts] = BEGIN
    return first, second, np.repeat(np.arange(len(texts)), sizes)


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches whose texts have about `BATCH_CHARS` characters."""
    for batch in batches:
        texts = batch.column(at).to_pylist()
        start = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= BATCH_CHARS or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, size = i + 1, 0


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows sorted by the keys, the last one leading, with the values of equal rows added up."""
    order = np.lexsort(keys)
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    starts = np.flatnonzero(new)
    if not len(starts):
        return keys, values
    return [k[starts] for k in keys], [np.add.reduceat(v[order], starts) for v in values]


def _pairs(docs: DataFrame, shards: int) -> DataFrame:
    """Counted pairs per block of texts and shard: each first word once, with how many second words follow it."""
    names = ["shard", "first", "follow", "second", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _blocks(batches, 0):
            first, second, _ = _sequences(texts)
            (second, first), (n,) = _summed([second, first], [np.ones(len(first), np.int64)])
            where = _shard(first, shards)
            out = []
            by = np.argsort(where, kind="stable")
            edges = np.searchsorted(where[by], np.arange(shards + 1))
            for s in range(shards):
                part = by[edges[s] : edges[s + 1]]
                if len(part):
                    starts = np.flatnonzero(np.append(True, first[part][1:] != first[part][:-1]))
                    follow = np.diff(starts, append=len(part)).astype("<u4")
                    columns = (first[part][starts], follow, second[part], n[part].astype("<u4"))
                    out.append((s, *(c.tobytes() for c in columns)))
            if out:
                kinds = [pa.int32(), *[pa.binary()] * 4]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.record_batch(columns, names=names)

    return docs.select("text").mapInArrow(run, "shard int, first binary, follow binary, second binary, n binary")


def _read(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array file. A repeated attempt writes the same bytes to the same place, under another name first."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    own = f"{root}/.{name}-{os.getpid()}-{np.random.default_rng().integers(1 << 62)}"
    with store.open_output_stream(own) as out:
        out.write(array.tobytes())
    store.move(own, f"{root}/{name}")


def _four(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def discounts(n: list[int]) -> list[float]:
    """What is taken off counts of 1, 2 and 3 or more (index by the smaller of count and 3), from counts of counts."""
    n1, n2, n3, n4 = (int(x or 0) for x in n)
    plain = [0.0, 0.5, 1.0, 1.5]  # where there are too few counts to estimate from
    if not n1 or not n2:
        return plain
    y = n1 / (n1 + 2 * n2)
    found = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, p / 10), i - 0.1) if i else 0.0 for i, (d, p) in enumerate(zip(found, plain, strict=True))]


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that belong to the whole corpus."""

    folder: str
    shards: int
    tokens: int = 0  # N
    types: int = 0  # V
    pairs: int = 0  # different pairs
    pair_discount: list[float] = field(default_factory=lambda: [0.0, 0.5, 1.0, 1.5])
    word_discount: list[float] = field(default_factory=lambda: [0.0, 0.5, 1.0, 1.5])
    spare: float = 1.0  # mass that the continuation counts leave to the uniform distribution

    def arrays(self) -> Arrays:
        return Arrays(self)


def train(docs: DataFrame) -> Model:
    """Count all texts of `docs`; null texts are empty ones, which have an end and nothing else.

    Pairs are summed per block of texts before they are shuffled, so copies and
    frequent pairs shrink; a shard gets about as much for any input, and no
    pair, however frequent, has more than one row per block of texts.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    model = Model(work_dir(spark, "ngrams"), max(1, math.ceil(chars / SHARD_CHARS)))
    folder, shards, narrow = model.folder, model.shards, NARROW

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        first = np.repeat(_read(rows["first"], "<u8"), _read(rows["follow"], "<u4"))
        n = _read(rows["n"], "<u4").astype(np.int64)
        (second, first), (n,) = _summed([_read(rows["second"], "<u8"), first], [n])
        starts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        of = [np.add.reduceat(x.astype(np.int64), starts) for x in (n, n == 1, n == 2, n > 2)]
        order = np.argsort(first[starts])
        _save(folder, f"first-{shard:07d}", first[starts][order])
        _save(folder, f"after-{shard:07d}", np.column_stack(of)[order])
        keys = pair_keys(first, second)
        order = np.argsort(keys)
        _save(folder, f"pair-{shard:07d}", keys[order])
        name, kind = ("count", "<u4") if n.max() < narrow else ("wide", "<i8")
        _save(folder, f"{name}-{shard:07d}", n[order].astype(kind))
        (word,), (before, total) = _summed([second], [np.ones(len(second), np.int64), n])
        where = _shard(word, shards)
        out = []
        for s in np.unique(where).tolist():
            at = where == s
            columns = (word[at], before[at].astype("<u4"), total[at])
            out.append((s, *(c.tobytes() for c in columns), None, 0))
        out.append((None, None, None, None, _four(n), len(n)))
        return pd.DataFrame(out, columns=["shard", "word", "before", "total", "four", "pairs"])

    ddl = "shard int, word binary, before binary, total binary, four array<long>, pairs long"
    path = work_dir(spark, "continuations")
    _pairs(docs, shards).groupBy("shard").applyInPandas(merge, ddl).write.parquet(path)
    merged = spark.read.schema(ddl).parquet(path)

    def unite(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        before = _read(rows["before"], "<u4").astype(np.int64)
        (word,), (before, total) = _summed([_read(rows["word"], "<u8")], [before, _read(rows["total"], "<i8")])
        _save(folder, f"word-{shard:07d}", word)
        _save(folder, f"seen-{shard:07d}", np.column_stack([total, before]))
        row = (len(word), int(total.sum()), int(before.sum()), _four(before), int((before > 2).sum()))
        return pd.DataFrame([row], columns=["types", "tokens", "before", "four", "more"])

    words_of = merged.filter("shard is not null").select("shard", "word", "before", "total").groupBy("shard")
    words_of = words_of.applyInPandas(unite, "types long, tokens long, before long, four array<long>, more long")
    four = [F.sum(F.col("four")[i]).alias(f"n{i}") for i in range(4)]
    w = words_of.agg(*[F.sum(c).alias(c) for c in ("types", "tokens", "before", "more")], *four).first()
    p = merged.filter("shard is null").agg(F.sum("pairs").alias("pairs"), *four).first()
    if not w["types"]:
        return model
    model.types, model.tokens, model.pairs = w["types"], w["tokens"], p["pairs"]
    model.pair_discount = discounts([p[f"n{i}"] for i in range(4)])
    model.word_discount = d = discounts([w[f"n{i}"] for i in range(4)])
    model.spare = (d[1] * w["n0"] + d[2] * w["n1"] + d[3] * w["more"]) / w["before"]
    return model


class Arrays:
    """The model's arrays, mapped into a worker's memory as they are needed."""

    def __init__(self, model: Model):
        self.model, self.open_ = model, {}
        self.copies = None

    def _map(self, name: str, shard: int, kind: str) -> np.ndarray:
        key = (name, shard)
        if key not in self.open_:
            uri = f"{self.model.folder}/{name}-{shard:07d}"
            store, path = fs.FileSystem.from_uri(uri)
            info = store.get_file_info(path)
            if info.type == fs.FileType.NotFound or not info.size:
                self.open_[key] = np.zeros(0, kind)
            else:
                if not isinstance(store, fs.LocalFileSystem):  # only local files can be mapped
                    self.copies = self.copies or tempfile.TemporaryDirectory()
                    local = f"{self.copies.name}/{name}-{shard:07d}"
                    with store.open_input_stream(path) as source, open(local, "wb") as target:
                        shutil.copyfileobj(source, target, 1 << 22)
                    path = local
                self.open_[key] = np.memmap(path, kind, "r")
        return self.open_[key]

    def find(self, keys: np.ndarray, shard_of: np.ndarray, table: str, values: str, kind: str, width: int) -> np.ndarray:
        """The values of sorted, distinct keys, a row each; zeros for those that the model does not have."""
        out = np.zeros((len(keys), width), np.int64)
        by = np.argsort(shard_of, kind="stable")
        edges = np.searchsorted(shard_of[by], np.arange(self.model.shards + 1))
        for s in np.flatnonzero(np.diff(edges)).tolist():
            at = by[edges[s] : edges[s + 1]]
            known = self._map(table, s, "<u8")
            if len(known):
                place = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
                hit = known[place] == keys[at]
                found = self._map(values, s, kind)
                if not len(found):  # a shard with a count beyond 32 bits
                    found = self._map("wide", s, "<i8")
                out[at[hit]] = found.reshape(-1, width)[place[hit]]
        return out

    def score(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text: tokens, known tokens, the base score and the model's log10 probability."""
        m = self.model
        first, second, owner = _sequences(texts)
        word, of_word = np.unique(second, return_inverse=True)
        seen = self.find(word, _shard(word, m.shards), "word", "seen", "<i8", 2)
        d = np.array(m.word_discount)
        before = seen[:, 1]
        kept = (before - d[np.minimum(before, 3)]) / max(1, m.pairs)  # each different pair counts once for its second word
        lower = (np.maximum(kept, 0) + m.spare / (m.types + 1))[of_word]
        head, of_head = np.unique(first, return_inverse=True)
        after = self.find(head, _shard(head, m.shards), "first", "after", "<i8", 4)
        keys = pair_keys(first, second)
        pair, at, of_pair = np.unique(keys, return_index=True, return_inverse=True)
        count = self.find(pair, _shard(first[at], m.shards), "pair", "count", "<u4", 1)[of_pair, 0]
        d = np.array(m.pair_discount)
        total = np.maximum(after[:, 0], 1)
        back = np.where(after[:, 0] > 0, (d[1] * after[:, 1] + d[2] * after[:, 2] + d[3] * after[:, 3]) / total, 1.0)
        p = np.maximum(count - d[np.minimum(count, 3)], 0) / total[of_head] + back[of_head] * lower
        base = np.log10((seen[:, 0] + 1) / (m.tokens + m.types + 1))[of_word]
        known = (seen[:, 0] > 0)[of_word]
        size = len(texts)
        return [
            np.bincount(owner, minlength=size),
            np.bincount(owner, known, size).astype(np.int64),
            np.bincount(owner, base, size),
            np.bincount(owner, np.log10(p), size),
        ]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `n_tokens, n_known, train_tokens, base_score, score` (log10 probability of the whole text).

    Null and empty texts are a lone end. Every row gives a row; existing
    columns of these names are replaced. A model of an empty corpus gives every
    token the probability 1 (there is one unknown type).
    """
    names = [c.split()[0] for c in SCORED.split(", ")]
    rest = docs.drop(*[n for n in names if n != text])
    at, tokens = rest.columns.index(text), model.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = model.arrays()
        for batch, texts in _blocks(batches, at):
            n, known, base, found = arrays.score(texts)
            extra = [n, known, np.full(len(n), tokens), base, found]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            columns = [pa.array(x, k) for x, k in zip(extra, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return rest.mapInArrow(run, extended(rest, SCORED))


def perplexity(score: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score / n_tokens)
