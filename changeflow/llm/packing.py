"""Packing of documents into fixed-length token sequences.

First-fit decreasing over a tournament tree of bin capacities, run on its own
in each of many groups that documents are dealt to at random.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import mix
from changeflow.session import work_dir

LIMIT = 2048
END_ID = 1
GROUP_DOCS = 2048  # expected documents of a group
BLOCK = 1_000_000  # characters of text that are encoded at a time, with about 70 bytes of arrays each
CACHE = 1_000_000  # chunks that a worker remembers between blocks, about 50 bytes each
TOKENIZER = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"
#: Fixed: how byte-level BPE cuts a text before it merges.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECE = "piece_no long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)

#: A space that no visible character follows; there a cut before every space would cut a token.
_ODD_SPACE = re.compile(r" (?!\S)")


class Encoder:
    """Token ids of texts, as arrays of unsigned 32-bit integers.

    Byte-level BPE never joins a space that a visible character follows to
    what stands before it, so a text is the concatenation of its chunks cut
    before such spaces, and a chunk's ids depend on the chunk alone. Words
    repeat, so each different chunk of a block of texts is merged once, by
    `tiktoken` over the ranks of the same vocabulary file, and its ids are
    copied to wherever it stands. Chunks are told apart by a 64-bit hash; equal
    hashes are checked byte by byte within a block, by size across blocks. Texts with other space runs or with the
    special token's string, and vocabularies whose merges are not in the order
    of their ids, are left to `tokenizers`.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = None
        if ranks := _ranks(path):
            encode = tiktoken.Encoding("ranks", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
            self.fast = encode.encode_ordinary
            self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
            self.bytes_of[list(ranks.values())] = [len(k) for k in ranks]
            self.byte_hash = mix(np.arange(1, 257, dtype=np.uint64))
            self.powers = np.ones(0, np.uint64)
            self._forget()

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order, worked on in blocks of about `BLOCK` bytes."""
        block: list[str] = []
        size = 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= BLOCK:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, texts: list[str]) -> Iterator[np.ndarray]:
        plain = [self.fast is not None and SPECIAL not in t and not _ODD_SPACE.search(t) for t in texts]
        cuts = [t.find(" ") for t in texts]
        tails = [t[c:].encode() if ok and c >= 0 else b"" for t, c, ok in zip(texts, cuts, plain, strict=True)]
        ids, ends = self._tails(tails)
        start = 0
        for text, cut, ok, end in zip(texts, cuts, plain, ends, strict=True):
            if not ok or ids is None:
                yield self.whole(text)
            else:
                head = np.array(self.fast(text[:cut] if cut >= 0 else text), np.uint32)
                yield np.concatenate([head, ids[start:end]])
            start = end

    def _tails(self, tails: list[bytes]) -> tuple[np.ndarray | None, list[int]]:
        """Ids of all texts' rests, each empty or starting with a space, and where each text's ids end.

        Worked on in slices of about `BLOCK` bytes that start with a space, so a
        very long text takes no more memory than many short ones.
        """
        data, stops = b"".join(tails), np.cumsum([len(t) for t in tails])
        ids, ends, start, n = [np.zeros(0, np.uint32)], np.zeros(len(tails), np.int64), 0, 0
        while start < len(data):
            cut = data.find(b" ", start + BLOCK)
            stop = cut if cut >= 0 else len(data)
            found = self._slice(np.frombuffer(data, np.uint8, stop - start, start), stops - start)
            if found is None:
                return None, [0] * len(tails)
            ends = np.where(stops > start, n + found[1], ends)
            ids.append(found[0])
            n, start = n + len(found[0]), stop
        return np.concatenate(ids), ends.tolist()

    def _slice(self, data: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of bytes that start with a space, and how many of them lie before each stop; None if hashes clash."""
        n = len(data)
        if len(self.powers) < n:  # powers of an odd number, and of its inverse modulo 2^64
            base = 0x9E3779B97F4A7C15
            self.powers = np.cumprod(np.full(n, base, np.uint64))
            self.inverse = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
        starts = np.flatnonzero(data == 32)
        lengths = np.diff(starts, append=n)
        total = np.cumsum(self.byte_hash[data] * self.powers[:n])
        before = np.where(starts > 0, total[starts - 1], np.uint64(0))
        key = mix((total[starts + lengths - 1] - before) * self.inverse[starts])
        keys, first, which = np.unique(key, return_index=True, return_inverse=True)
        at = np.arange(n)
        same = np.repeat(starts[first][which] - starts, lengths)
        same += at
        if (lengths[first][which] != lengths).any() or (data[np.minimum(same, n - 1)] != data).any():
            return None  # two chunks of one hash
        place = self._learn(keys, starts[first], lengths[first], data, at)
        if place is None:
            return None
        each = self.counts[place][which]
        ends = np.cumsum(each)
        found = self.pool[np.repeat(self.begins[place][which] - (ends - each), each) + np.arange(ends[-1])]
        return found, np.append(0, ends)[np.searchsorted(starts, stops)]

    def _forget(self) -> None:
        """Remembered chunks: hash (sorted), size in bytes, and where their ids lie in the pool."""
        self.keys, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.sizes, self.begins, self.counts = (np.zeros(0, np.int64) for _ in range(3))

    def _learn(self, keys, starts, sizes, data, at) -> np.ndarray | None:
        """Places of the given chunks among the remembered ones; those not yet known are encoded, all in one text."""
        if len(self.keys) > CACHE:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            near = np.minimum(place, len(self.keys) - 1)
            known = self.keys[near] == keys
            if (self.sizes[near] != sizes)[known].any():
                return None
        new = ~known
        if new.any():
            own = sizes[new]
            stops = np.cumsum(own)
            text = data[np.repeat(starts[new] - (stops - own), own) + at[: stops[-1]]].tobytes().decode()
            ids = np.array(self.fast(text), np.uint32)
            until = np.searchsorted(np.cumsum(self.bytes_of[ids]), stops) + 1
            counts = np.diff(until, prepend=0)
            begins = len(self.pool) + until - counts
            for name, more in (("keys", keys[new]), ("sizes", own), ("begins", begins), ("counts", counts)):
                setattr(self, name, np.insert(getattr(self, name), place[new], more))
            self.pool = np.concatenate([self.pool, ids])
        return np.searchsorted(self.keys, keys)


def _ranks(path: str) -> dict[bytes, int] | None:
    """Rank of every mergeable token of a byte-level BPE file; None where merge order and ids disagree."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    other = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    vocabulary = model["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocabulary.get(m, -1) for m in merged]
    if ids != sorted(set(ids)) or any(vocabulary.get(c, 1 << 31) >= ids[0] for c in byte):
        return None
    return {bytes(byte[c] for c in token): vocabulary[token] for token in [*byte, *merged]}


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """The worker's encoder, built once. `None` stands for the public file, looked up on the worker."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(
    docs: DataFrame, limit: int = LIMIT, tokenizer: str | None = None, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Every document's ids with `end_id` behind them, cut into pieces of `limit` and one shorter or equal last piece.

    One row per piece. A null text is an empty one: a single piece that holds
    `end_id`. Each row of `docs` is a document of its own, also where ids are
    null or repeated. `piece_no` is unique. `ids` (little-endian unsigned
    32-bit) is filled only with `keep_ids`.
    """
    end = np.asarray([end_id], np.uint32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, n = encoder(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            out: list[tuple] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, found in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                ids = np.append(found, end).astype("<u4", copy=False)
                for start in range(0, len(ids), limit):
                    part = ids[start : start + limit].tobytes()
                    length = len(part) // 4
                    out.append((n, doc_id, start, length, zlib.crc32(part), len(ids), part if keep_ids else None))
                    n += 1
                if keep_ids and len(out) >= 2000:
                    yield _batch(out, PIECE)
                    out = []
            yield _batch(out, PIECE)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names = [c.split() for c in ddl.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.record_batch(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, names, strict=True)], names=[n for n, _ in names]
    )


def first_fit_decreasing(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item; longest first, equal ones in their order, each into the first bin it fits.

    A tournament tree holds the room of every bin, each inner node the greatest
    room below it, so the first fitting bin is found on one way down.
    """
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [limit] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[item]), 1
        while node < leaves:
            node *= 2
            node += tree[node] < need
        bins[item], offsets[item] = node - leaves, limit - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins, offsets


def pack(pieces: DataFrame, limit: int = LIMIT, group_docs: int = GROUP_DOCS, seed: int = 17) -> DataFrame:
    """Place every piece: `sequence_id`, and `offset` inside the sequence without gaps.

    Whole pieces are sequences by themselves (negative ids). Shorter pieces, at
    most one per document, are dealt to groups by a hash of their number, so
    neither an order nor a hot source shapes a group, and each group is packed
    by itself. The number of groups follows the number of documents.
    `pieces` must give the same rows each time it is read (a written table).
    """
    whole = pieces.filter(F.col("length") == limit)
    last = pieces.filter(F.col("length") < limit)
    groups = max(1, math.ceil(last.count() / group_docs))
    names = [c.split()[0] for c in PLACED.split(", ")]

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece_no", kind="stable")
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), limit)
        return rows.assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)[names]

    placed = (
        last.withColumn("group", F.pmod(F.xxhash64("piece_no", F.lit(seed)), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(place, PLACED)
    )
    alone = whole.withColumn("sequence_id", -F.col("piece_no") - 1).withColumn("offset", F.lit(0).cast("long"))
    return alone.select(*names).unionByName(placed)


def pack_documents(
    docs: DataFrame, limit: int = LIMIT, tokenizer: str | None = None, end_id: int = END_ID,
    keep_ids: bool = False, group_docs: int = GROUP_DOCS, seed: int = 17,
) -> DataFrame:
    """`pieces`, written once below the shared folder, then `pack`ed."""
    spark = docs.sparkSession
    path = work_dir(spark, "pieces")
    pieces(docs, limit, tokenizer, end_id, keep_ids).write.parquet(path)
    return pack(spark.read.parquet(path), limit, group_docs, seed)
