"""Benchmark decontamination: test items found in documents by one Aho-Corasick automaton over words."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import LOWER, extended, guarded
from changeflow.session import work_dir

WINDOW = 13  # words of a window
BLOCK_CHARS = 16_000_000  # characters of test items that one automaton is built from

#: Fixed by the contract: what separates words, after A-Z became a-z. Letters outside ASCII are word characters.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_WORDS_ONLY = bytes(
    LOWER[b] if b > 127 or 48 <= b <= 57 or 97 <= LOWER[b] <= 122 else 32 for b in range(256)
)
_LOWER_TEXT = {c: c + 32 for c in range(65, 91)}
FOUND = "n_words long, hits array<struct<first:long,last:long,item_id:string>>"
_HITS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("item_id", pa.string())]))


def normalised(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_WORDS_ONLY).split() if text else []


class Automaton:
    """All windows of the items. Letters of the automaton are word numbers, so a scan takes a step per word."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in normalised(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                windows.setdefault(tuple(ids[i : i + window]), set()).add(item_id)
        self.scan = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, found in windows.items():
            self.scan.add_word(key, (len(key), tuple(sorted(found))))
        self.scan.make_automaton()
        self.empty = not windows

    def find(self, words: list[bytes]) -> list[tuple[int, int, str]]:
        """(first word, last word, item) of every stretch of words that overlapping windows of an item cover."""
        if self.empty or not words:
            return []
        get = self.number.get
        ids = tuple([get(w, 0) for w in words])
        open_: dict[str, list[int]] = {}
        done: list[tuple[int, int, str]] = []
        for end, (length, items) in self.scan.iter(ids):
            first = end - length + 1
            for item in items:
                last = open_.get(item)
                if last and first <= last[1] + 1:
                    last[0], last[1] = min(first, last[0]), end
                else:
                    if last:
                        done.append((last[0], last[1], item))
                    open_[item] = [first, end]
        return sorted(done + [(a, b, item) for item, (a, b) in open_.items()])


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`docs` with `n_words` and `hits`, the stretches of words that windows of items cover.

    `items` has `item_id` and `text`. A window is `window` consecutive words
    of an item; a shorter item is one window, an item without words none.
    Null ids of items count as the empty id, items with one id as one item.
    Null and empty texts have no words. Every row of `docs` gives a row.

    The items are sent to the executors: one block of them if they have at
    most `block_chars` characters, otherwise block by block, with the hits so
    far written below the shared folder in between. Documents are never
    shuffled, and each is scanned once per block.
    """
    spark = docs.sparkSession
    items = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    found = docs.drop("n_words", "hits")
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        if block:
            path = work_dir(spark, "hits")
            found.write.parquet(path)
            found = spark.read.parquet(path)
        found = _scan(found, [(r[0], r[1]) for r in part.collect()], window)
    return found


def _scan(docs: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)
    earlier = docs.columns.index("hits") if "hits" in docs.columns else None
    keep = [i for i, c in enumerate(docs.columns) if c not in ("n_words", "hits")]
    rest = docs.select(*[docs.columns[i] for i in keep])
    at, names = docs.columns.index("text"), [*rest.columns, "n_words", "hits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(sent.value, window)
        for batch in batches:
            counts, hits = [], []
            for row, text in enumerate(batch.column(at)):
                words = normalised(text.as_py())
                counts.append(len(words))
                old = batch.column(earlier)[row].as_py() if earlier is not None else []
                new = [{"first": a, "last": b, "item_id": i} for a, b, i in automaton.find(words)]
                hits.append(old + new)
            columns = [batch.column(i) for i in keep] + [pa.array(counts, pa.int64()), pa.array(hits, _HITS)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, extended(rest, FOUND))


def judge(found: DataFrame) -> DataFrame:
    """`n_hit`, `n_items`, `items_sha256` and `contaminated` from what `find` gave.

    A document is contaminated if at least a twentieth of its words, and one at
    least, stand inside windows of test items. A document without hits has the
    digest of the empty text.
    """
    step = F.aggregate(
        F.array_sort("hits"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("last")),
        lambda a, h: F.struct(
            (a["n"] + F.greatest(F.lit(0), h["last"] - F.greatest(h["first"] - 1, a["last"]))).alias("n"),
            F.greatest(a["last"], h["last"]).alias("last"),
        ),
        lambda a: a["n"],
    )
    items = F.array_sort(F.array_distinct(F.col("hits.item_id")))
    return (
        found.withColumn("n_hit", step)
        .withColumn("n_items", F.size(items).cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join(items, ",").cast("binary"), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def spans(found: DataFrame, text: str = "text") -> DataFrame:
    """`found` with `spans`: its hits as (start, end, item_id), offsets in characters of the text as it was."""
    rest = found.drop("spans")
    at, text_at = rest.columns.index("hits"), rest.columns.index(text)
    names = [*rest.columns, "spans"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("item_id", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for hits, body in zip(batch.column(at), batch.column(text_at), strict=True):
                hits = hits.as_py() or []
                where = [m.span() for m in WORD.finditer(body.as_py().translate(_LOWER_TEXT))] if hits else []
                out.append(
                    [{"start": where[h["first"]][0], "end": where[h["last"]][1], "item_id": h["item_id"]} for h in hits]
                )
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=names)

    return rest.mapInArrow(run, extended(rest, "spans array<struct<start:long,end:long,item_id:string>>"))


def reject(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with."""
    safe, back = guarded(docs)
    return back(judge(find(safe, items)).filter(~F.col("contaminated")))
