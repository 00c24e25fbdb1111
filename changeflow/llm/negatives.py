"""Hard negatives: rows of another label that score almost as high as a row of the anchor's label.

Vectors are integers, scores their inner products. Every vector x is rotated
and its signs are kept as a one-bit code: the unit vector c with the signs of
x. Stored with the code is its alignment a = <x, c>, so x = a c + r with a
residual r at right angles to c, whose length follows from that of x. For an
anchor q, rotated and cut into eight bit planes, <q, c> comes from popcounts,
and by Cauchy-Schwarz

    <q, x> = a <q, c> + <q, r>,  |<q, r>| <= |q - <q, c> c| |r|.

That interval is certain, as what the bit planes leave of q is added to it. Only
rows whose interval can still enter the best rows of an anchor are scored in
integers; results are exact.

Anchors and rows are both cut into blocks; every pair of blocks is a group of
its own. A group keeps a few rows per anchor, and these are merged by rank.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeflow.llm.common import written

SCALE = 256
LIMIT = 1 << 27  # components beyond are cut to it: so sums of 512 products fit into 64 bits
PLANES = 8  # bits of a rotated component of an anchor
KEEP = 5  # positives of an anchor, negatives of a positive
LEAST, MOST = 80, 100  # per cent of the positive's score that a negative's may be
ANCHOR_BLOCK, ROW_BLOCK = 16_384, 65_536  # rows in a group, about
SPREAD = 4_096  # rows a group has at least while there are tasks to fill
CHUNK = 1_024, 4_096  # anchors and rows whose intervals are computed at once
CODES = "vec_id long, label long, dim int, ints binary, code binary, norm double, align double"


@functools.lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    return np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0]


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    n, dim = bits.shape
    padded = np.zeros((n, max(1, -(-dim // 64)) * 64), bool)
    padded[:, :dim] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def codes(rows: DataFrame) -> DataFrame:
    """`vec_id, label, dim` with the integer vector, its one-bit code, length and alignment with the code."""
    part = rows.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("v")
    )
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    part = part.filter("vec_id is not null and label is not null and v is not null").filter(whole)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                yield from encoded(batch.slice(lo, 4096))

    def encoded(batch):
        sizes = np.asarray(batch.column(2).value_lengths())
        for dim in np.unique(sizes):
            some = batch.take(pa.array(np.flatnonzero(sizes == dim)))
            x = np.asarray(some.column(2).flatten(), np.float64).reshape(some.num_rows, dim)
            ints = np.clip(np.floor(SCALE * x), -LIMIT, LIMIT).astype("<i4")
            turned = ints.astype(np.float64) @ rotation(int(dim)) if dim else ints.astype(np.float64)
            align = np.abs(turned).sum(axis=1) / math.sqrt(max(1, dim))
            norm = np.sqrt((ints.astype(np.float64) ** 2).sum(axis=1))
            columns = [
                some.column(0), some.column(1), pa.array(np.full(some.num_rows, dim), pa.int32()),
                pa.array([r.tobytes() for r in ints], pa.binary()),
                pa.array([r.tobytes() for r in packed(turned > 0)], pa.binary()), pa.array(norm), pa.array(align),
            ]
            names = [f.split()[0] for f in CODES.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return part.mapInArrow(run, CODES)


class Side:
    """The vectors of a group as arrays."""

    def __init__(self, rows: pa.Table, dim: int):
        self.n, self.dim = rows.num_rows, dim
        column = lambda name: rows.column(name).to_numpy()
        self.id, self.label, self.norm, self.align = (column(c) for c in ("vec_id", "label", "norm", "align"))
        binary = lambda name, kind: np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)
        self.ints = binary("ints", "<i4").reshape(self.n, dim)
        self.code = binary("code", "<u8").reshape(self.n, max(1, -(-dim // 64)))
        self.ones = np.bitwise_count(self.code).sum(axis=1, dtype=np.int64)
        self.residual = np.sqrt(np.maximum(0.0, self.norm**2 - self.align**2))


class Planes:
    """Rotated anchors as bit planes: `low + step * (number in the planes)`, `left` being the length of the rest."""

    def __init__(self, side: Side, lo: int, hi: int):
        turned = side.ints[lo:hi].astype(np.float64) @ rotation(side.dim)
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / ((1 << PLANES) - 1), 1e-12)
        cells = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        near = self.low[:, None] + self.step[:, None] * cells
        self.left = np.sqrt(((turned - near) ** 2).sum(axis=1))
        self.sum, self.norm = near.sum(axis=1), side.norm[lo:hi]
        self.words = [packed(cells >> p & 1 > 0) for p in range(PLANES)]

    def intervals(self, rows: Side, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of every anchor with every row."""
        code, dots = rows.code[lo:hi], 0
        for p, plane in enumerate(self.words):
            for w in range(code.shape[1]):
                dots = dots + (np.bitwise_count(plane[:, w, None] & code[None, :, w]).astype(np.int32) << p)
        along = 2 * (self.low[:, None] * rows.ones[lo:hi] + self.step[:, None] * dots) - self.sum[:, None]
        along /= math.sqrt(rows.dim)
        certain = np.maximum(0.0, np.abs(along) - self.left[:, None])
        across = np.sqrt(np.maximum(0.0, self.norm[:, None] ** 2 - certain**2))
        align, residual = rows.align[lo:hi], rows.residual[lo:hi]
        middle = align * along
        wide = align * self.left[:, None] + across * residual
        wide += 1e-9 * self.norm[:, None] * rows.norm[lo:hi] + 1e-6  # what floating point may lose
        return middle - wide, middle + wide


def scores(anchors: Side, rows: Side, a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs."""
    out = np.empty(len(a), np.int64)
    for lo in range(0, len(a), 1 << 16):
        at = slice(lo, lo + (1 << 16))
        out[at] = np.einsum("ij,ij->i", anchors.ints[a[at]].astype(np.int64), rows.ints[x[at]].astype(np.int64))
    return out


class Best:
    """The first `KEEP` rows of every slot: greater scores first, then smaller ids."""

    def __init__(self, slots: int):
        self.slot, self.id, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.floor = np.full(slots, -np.inf)  # a score under it cannot enter

    def add(self, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(slot):
            return
        slot, ids = np.concatenate([self.slot, slot]), np.concatenate([self.id, ids])
        score = np.concatenate([self.score, score])
        order = np.lexsort((ids, -score, slot))
        slot, ids, score = slot[order], ids[order], score[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot, side="left")
        kept = rank < KEEP
        self.slot, self.id, self.score = slot[kept], ids[kept], score[kept]
        last = rank[kept] == KEEP - 1
        self.floor[self.slot[last]] = self.score[last]


def _positives(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Rows of the anchor's label that are among its best in this group."""
    dim = key[0].as_py()
    mine, other, found = Side(anchors, dim), Side(rows, dim), Best(anchors.num_rows)
    for a in range(0, mine.n, CHUNK[0]):
        b = min(a + CHUNK[0], mine.n)
        planes = Planes(mine, a, b) if dim else None
        for x in range(0, other.n, CHUNK[1]):
            y = min(x + CHUNK[1], other.n)
            hit = (mine.label[a:b, None] == other.label[x:y]) & (mine.id[a:b, None] != other.id[x:y])
            if dim:
                hit &= planes.intervals(other, x, y)[1] >= found.floor[a:b, None]
            i, j = (v.astype(np.int64) + s for v, s in zip(np.nonzero(hit), (a, x), strict=True))
            found.add(i, other.id[j], scores(mine, other, i, j))
    at = pa.array(found.slot)
    columns = [anchors.column("vec_id").take(at), anchors.column("key").take(at), pa.array(found.id), pa.array(found.score)]
    return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns],
                                names=["anchor_id", "key", "id", "score"])


def _negatives(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Rows of other labels that are among the best under a positive's score, for every positive of the anchors."""
    dim = key[0].as_py()
    mine, other = Side(anchors, dim), Side(rows, dim)
    top = np.full((mine.n, KEEP), np.iinfo(np.int64).min)
    for i, p in enumerate(anchors.column("positives").to_pylist()):
        top[i, : len(p)] = p
    least = -(-LEAST * np.maximum(top, 0) // MOST)  # no score is between a negative one and a share of it
    none, found = top < 0, Best(mine.n * KEEP)
    for a in range(0, mine.n, CHUNK[0]):
        b = min(a + CHUNK[0], mine.n)
        planes = Planes(mine, a, b) if dim else None
        for x in range(0, other.n, CHUNK[1]):
            y = min(x + CHUNK[1], other.n)
            differ, hit = mine.label[a:b, None] != other.label[x:y], False
            low, high = planes.intervals(other, x, y) if dim else (0, np.zeros((b - a, y - x)))
            floor = found.floor.reshape(mine.n, KEEP)
            for k in range(KEEP):
                enters = high >= np.maximum(least[a:b, k], floor[a:b, k])[:, None]
                hit = hit | (enters & (low <= top[a:b, k, None]) & ~none[a:b, k, None])
            i, j = (v.astype(np.int64) + s for v, s in zip(np.nonzero(differ & hit), (a, x), strict=True))
            score = scores(mine, other, i, j)
            for k in range(KEEP):
                fits = (score >= least[i, k]) & (score <= top[i, k]) & ~none[i, k]
                found.add(i[fits] * KEEP + k, other.id[j[fits]], score[fits])
    at = pa.array(found.slot // KEEP)
    columns = [anchors.column("vec_id").take(at), anchors.column("key").take(at), pa.array(found.slot % KEEP + 1),
               pa.array(found.id), pa.array(found.score)]
    return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns],
                                names=["anchor_id", "key", "nth", "id", "score"])


def _grid(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, run, ddl: str) -> DataFrame:
    """`run` for every block of anchors with every block of rows."""
    spark = rows.sparkSession
    tasks = 4 * spark.sparkContext.defaultParallelism
    splits = max(-(-n_rows // ROW_BLOCK), min(-(-n_rows // SPREAD), tasks), 1)
    blocks = max(-(-n_anchors // ANCHOR_BLOCK), 1)
    one = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("block", one(blocks)).withColumn("split", every(splits))
    right = rows.withColumn("split", one(splits)).withColumn("block", every(blocks))
    keys, n = ["dim", "block", "split"], min(blocks * splits, 10_000)
    # Little data is much work here, so the number of tasks is not left to its size.
    left, right = left.repartition(n, *keys), right.repartition(n, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, ddl)


def _ranked(found: DataFrame, group: list[str]) -> DataFrame:
    best = Window.partitionBy(*group).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= KEEP)


def mine(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    `rows` and `anchors` have `vec_id`, `label` and `embedding`. Components become
    floor(256 x), at most 2^27 in size; a score is the integer inner product. An
    anchor's positives are its five best rows of its label, greater scores first,
    then smaller ids; a positive's negatives are the five best rows of another
    label whose score is 80 to 100 % of the positive's. Anchors without a
    positive or negative have no rows in the result.

    Rows with a null id, label or vector, or with a null, infinite or undefined
    component take no part. Vectors are compared with those of their length
    only; empty ones score 0. A repeated row is a row of its own, but no row
    meets one of its own id; repeated anchors are one. Other columns are ignored.
    """
    coded = written(codes(rows), "codes")
    asked = codes(anchors).withColumn("key", F.xxhash64("label", "ints")).dropDuplicates(["vec_id", "key"])
    asked = written(asked, "anchors")
    n_rows, n_anchors = coded.count(), asked.count()
    best = _grid(asked, coded, n_anchors, n_rows, _positives, "anchor_id long, key long, id long, score long")
    best = written(_ranked(best, ["anchor_id", "key"]), "positives")
    of = best.groupBy("anchor_id", "key").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    of = of.select(F.col("anchor_id").alias("vec_id"), "key", F.transform("p", lambda p: p["score"]).alias("positives"))
    ddl = "anchor_id long, key long, nth long, id long, score long"
    found = _grid(asked.join(of, ["vec_id", "key"]), coded, n_anchors, n_rows, _negatives, ddl)
    found = _ranked(found, ["anchor_id", "key", "nth"])
    pairs = found.alias("n").join(
        best.alias("p"), F.expr("n.anchor_id = p.anchor_id AND n.key = p.key AND n.nth = p.rank")
    )
    return pairs.select(
        "n.anchor_id", F.col("p.id").alias("positive_id"), "n.rank", F.col("n.id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"),
    )
