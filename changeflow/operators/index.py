"""Point index: upsert, garbage collection, reconcile, filtered search."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeflow.functions.vectors import Embedder, with_vectors
from changeflow.session import append_row, delete_path, listed, path_exists

# Payload fields that take a filter.
FILTERABLE = ("namespace", "alertnames", "confirmation", "outcome", "confidence", "section")

# Bytes of query and of point vectors in one group, queries and points whose similarities are computed at once.
QUERY_BYTES, POINT_BYTES = 32 << 20, 64 << 20
TILE = 2048
MOST_TASKS = 10_000

# Similarities are compared to this many digits, so that copies of a vector tie.
DIGITS = 9


class EmptySource(RuntimeError):
    """No points, but the target holds some: the source is more likely broken than empty."""


def upsert(target: DataFrame, incoming: DataFrame, key: str = "point_id") -> DataFrame:
    """`incoming` replaces rows of the same id, the others stay. Ids in `incoming` are unique.

    The rebalancing keeps Spark 4.1 from taking the union as hashed by id.
    """
    kept = target.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming.hint("rebalance"))


def collect_garbage(points: DataFrame, run_id: str, column: str = "run_id") -> DataFrame:
    """Only points of the current run; a missing run id counts as another run."""
    return points.filter(F.col(column).eqNullSafe(F.lit(run_id)))


def distinct_points(points: DataFrame, copies: str | None = None) -> DataFrame:
    """One point per id: of reports with the same key, the greatest path wins.

    Combines before the shuffle, so however many copies a point has, each task
    sends one. `copies` names a column to count them in.
    """
    rest = [c for c in points.columns if c != "point_id"]
    best = F.max_by(F.struct(*rest), F.col("path")).alias("_point")
    counts = [F.count(F.lit(1)).alias(copies)] if copies else []
    return points.groupBy("point_id").agg(best, *counts).select("point_id", "_point.*", *([copies] if copies else []))


def guard_source(n_points: int, target_exists: bool, allow_empty_first_run: bool = True) -> None:
    """Stop before garbage collection could empty a target.

    All or nothing, as a half-empty source passes. A first run may be empty
    where the caller allows that; document chunks never may.
    """
    if n_points == 0 and (target_exists or not allow_empty_first_run):
        raise EmptySource("0 points to index; leaving the target as it is")


def reconcile(points: DataFrame) -> DataFrame:
    """The index after a full refresh with this run's points.

    Upserting all points of a run and then removing those of other runs leaves
    exactly this run's points, so the old index need not be read at all.
    """
    return distinct_points(points)


class PointIndex:
    """A collection of points on Parquet: one folder per run, a row names the live one.

    `grace` is how long a folder stays once another one is live, for jobs that
    began to read it before; without it such a job can fail half-way. One run
    refreshes a collection at a time.
    """

    def __init__(
        self, spark: SparkSession, root: str, vector: str = "vector", dim: int = 64, grace: timedelta = timedelta(0)
    ):
        self.spark, self.root, self.vector, self.dim, self.grace = spark, root.rstrip("/"), vector, dim, grace

    RUNS = "run_id string, at timestamp, path string, vector string, dim int, points_in bigint, points bigint"

    def runs(self) -> DataFrame:
        """Counts and schema of every run so far."""
        if not path_exists(self.spark, f"{self.root}/runs"):
            return self.spark.createDataFrame([], self.RUNS)
        return self.spark.read.schema(self.RUNS).parquet(f"{self.root}/runs")

    def live(self):
        return self.runs().orderBy(F.desc("at"), F.desc("run_id")).limit(1).first()

    def compatible(self) -> bool:
        """Whether the stored points have this vector name and dimension."""
        live = self.live()
        return live is not None and (live["vector"], live["dim"]) == (self.vector, self.dim)

    def read(self) -> DataFrame | None:
        """The live points; none if the collection is new or has to be recreated."""
        return self.spark.read.parquet(self.live()["path"]).drop("_copies") if self.compatible() else None

    def refresh(
        self,
        points: DataFrame,
        run_id: str,
        now: datetime,
        allow_empty_first_run: bool = True,
        embed: Embedder | None = None,
    ) -> dict[str, int]:
        """Replace the collection by this run's points. Returns the counts.

        Points without a vector column get one after their copies are merged,
        so no copy is embedded and no vector is shuffled. The new folder is
        written, counted and checked for the dimension first; the collection
        changes only with the row that names it, so a refused run leaves it
        untouched and its folder goes. An empty source is refused before
        anything is embedded. Folders that were replaced, or left by a run that
        died before naming its own, go once the grace period is over.
        """
        exists = self.compatible()
        if (exists or not allow_empty_first_run) and points.isEmpty():
            guard_source(0, exists, allow_empty_first_run)
        path = f"{self.root}/points/{_micros(now)}-{uuid.uuid4().hex}"
        merged = distinct_points(points, copies="_copies")
        if self.vector not in points.columns:
            merged = with_vectors(merged, embed, into=self.vector, dim=self.dim)
        merged.write.parquet(path)
        size = F.coalesce(F.size(self.vector), F.lit(-1))
        written = self.spark.read.parquet(path).agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("points_in"), F.count(F.lit(1)).alias("points"),
            F.count_if(size != self.dim).alias("others"),
        ).first()
        try:
            guard_source(written["points"], exists, allow_empty_first_run)
            if written["others"]:
                raise ValueError(f"{written['others']} points have no vector of {self.dim} numbers")
        except Exception:
            delete_path(self.spark, path)
            raise
        row = (run_id, now, path, self.vector, self.dim, written["points_in"], written["points"])
        append_row(self.spark, f"{self.root}/runs", self.RUNS, *row)
        self._sweep(now)
        return {"points_in": written["points_in"], "points": written["points"]}


    def _sweep(self, now: datetime) -> None:
        """Delete folders that stopped being live, or were begun and never named, a grace period ago.

        A folder stops being live when the next run is named; that run's folder
        is still there, as it stops later. So the folders listed are enough.
        """
        folders = {path.rstrip("/").rsplit("/", 1)[-1]: path for path in listed(self.spark, f"{self.root}/points")}
        named = self.runs().select("run_id", F.unix_micros("at").alias("at"), F.substring_index("path", "/", -1).alias("name"))
        runs = sorted((r["at"], r["run_id"], r["name"]) for r in named.filter(F.col("name").isin(list(folders))).collect())
        ends = {name: at for (_, _, name), (at, _, _) in zip(runs, runs[1:])}
        ends.update({n: _begun(n) for n in folders.keys() - {name for _, _, name in runs}})
        for name, end in ends.items():
            if end + self.grace // timedelta(microseconds=1) <= _micros(now):
                delete_path(self.spark, folders[name])


def _micros(at: datetime) -> int:
    """Microseconds since 1970; a time without a zone is in UTC."""
    own = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return (own - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def _begun(folder: str) -> int:
    """When the run of a folder began, as its name says; 0 for names of another form."""
    start = folder.partition("-")[0]
    return int(start) if start.isdecimal() else 0


def point_filter(**fields: str) -> Column:
    """Conjunction of exact matches on payload fields; a missing field never matches."""
    condition = F.lit(True)
    for name, value in fields.items():
        if name not in FILTERABLE:
            raise ValueError(f"no filter on {name!r}; filterable: {', '.join(FILTERABLE)}")
        field = F.col(f"metadata.{name}")
        hit = F.array_contains(field, value) if name == "alertnames" else field == value
        condition = condition & F.coalesce(hit, F.lit(False))
    return condition


def _unit(matrix: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)


def _best(query: np.ndarray, ids: np.ndarray, sims: np.ndarray, k: int):
    """The k best of each query among flat candidates; the smaller id first among equals."""
    order = np.lexsort((ids, -np.round(sims, DIGITS), query))
    query, ids, sims = query[order], ids[order], sims[order]
    first = np.searchsorted(query, query, side="left")
    kept = np.arange(len(query)) - first < k
    return query[kept], ids[kept], sims[kept]


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    flat = vectors.combine_chunks().flatten()
    return np.asarray(flat, dtype=np.float64).reshape(len(vectors), -1)


def _search(queries: pa.Table, points: pa.Table, k: int, filtered: bool, tile: int) -> pa.Table:
    """Up to k points of this split for every query of this block, tile by tile."""
    kinds = queries.schema.field("query_id").type, points.schema.field("id").type
    empty = pa.table([pa.array([], t) for t in (*kinds, pa.float64())], names=["query_id", "id", "sim"])
    if not queries.num_rows or not points.num_rows:
        return empty
    unit = _unit(_matrix(queries.column("vector")))
    with np.errstate(invalid="ignore", over="ignore"):
        others = _unit(_matrix(points.column("vector")))
    ids = np.array(points.column("id").to_pylist())
    wanted, values = (np.array(t.column("wanted").to_pylist()) if filtered else None for t in (queries, points))
    found = [[], [], []]
    for top in range(0, len(unit), tile):
        rows = unit[top : top + tile]
        best, floor = None, np.full(len(rows), -np.inf)
        for left in range(0, len(others), tile):
            with np.errstate(invalid="ignore", over="ignore"):
                sims = rows @ others[left : left + tile].T
            # A vector with an infinite or undefined number is similar to nothing.
            fits = np.isfinite(sims) & (np.round(sims, DIGITS) >= floor[:, None])
            if filtered:
                fits &= wanted[top : top + tile, None] == values[None, left : left + tile]
            if not fits.any():
                continue
            rounded = np.where(fits, np.round(sims, DIGITS), -np.inf)
            nth = max(0, rounded.shape[1] - k)
            query, at = np.nonzero(fits & (rounded >= np.partition(rounded, nth, axis=1)[:, nth, None]))
            new = query, ids[left + at], sims[query, at]
            best = _best(*(new if best is None else (np.concatenate(c) for c in zip(best, new, strict=True))), k)
            full = np.flatnonzero(np.bincount(best[0], minlength=len(rows)) == k)
            last = np.searchsorted(best[0], full, side="right") - 1
            floor[full] = np.round(best[2][last], DIGITS)
        if best is not None:
            for column, values_of in zip(found, (best[0] + top, best[1], best[2]), strict=True):
                column.append(values_of)
    if not found[0]:
        return empty
    query, point, sim = (np.concatenate(c) for c in found)
    names = queries.column("query_id").combine_chunks().take(pa.array(query))
    return pa.table([names, pa.array(point.tolist(), kinds[1]), pa.array(sim)], names=["query_id", "id", "sim"])


def cosine_topk(
    points: DataFrame,
    queries: DataFrame,
    k: int = 5,
    point: str = "vec_id",
    vector: str = "embedding",
    field: str | None = None,
) -> DataFrame:
    """The k most similar points of every query, exactly: `query_id, rank, <point>, sim`.

    `queries` has `query_id`, `vector` and, with `field`, the value `wanted` in
    that payload field of the points. Queries are dealt into blocks and points
    into splits of bounded bytes, and every block meets every split in a group
    of its own, which keeps k points per query; those are merged by rank. So
    neither queries nor points pass through the driver, and more queries are
    more groups, not more plan. Points whose vector has another length or a
    null in it cannot be compared and are left out; those with an infinite or
    undefined number are similar to nothing. Query vectors must all have one
    length.
    """
    size = F.size("vector")
    shape = queries.agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("dim"), F.min(size).alias("least")).first()
    if not shape["n"]:
        raise ValueError("no query vectors")
    if shape["least"] != shape["dim"]:
        raise ValueError(f"query vectors have {shape['least']} to {shape['dim']} numbers")
    dim = shape["dim"]
    wanted = ["wanted"] if field else []
    left = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"), *wanted)
    extra = [F.col(field).alias("wanted")] if field else []
    right = points.select(F.col(point).alias("id"), F.col(vector).cast("array<double>").alias("vector"), *extra)
    right = right.filter(" AND ".join(f"{c} is not null" for c in right.columns))
    right = right.filter((F.size("vector") == dim) & F.forall("vector", lambda x: x.isNotNull()))
    n_points, tasks = points.count(), 2 * points.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-shape["n"] * 8 * dim // QUERY_BYTES))
    splits = max(1, -(-n_points * 8 * dim // POINT_BYTES), min(-(-n_points // TILE), tasks))

    def dealt(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = left.withColumn("block", dealt("query_id", blocks)).withColumn("split", every(splits))
    right = right.withColumn("split", dealt("id", splits)).withColumn("block", every(blocks))
    # Little data is much work here: the number of tasks is not left to its size.
    n = min(blocks * splits, MOST_TASKS)
    left, right = left.repartition(n, "block", "split"), right.repartition(n, "block", "split")
    names, filtered, tile = ["query_id", "id"], field is not None, TILE
    kinds = [f.schema[c].dataType.simpleString() for f, c in ((left, names[0]), (right, names[1]))]
    found = left.groupBy("block", "split").cogroup(right.groupBy("block", "split")).applyInArrow(
        lambda q, p: _search(q, p, k, filtered, tile), f"query_id {kinds[0]}, id {kinds[1]}, sim double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc(F.round("sim", DIGITS)), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(point), "sim")
