"""Near duplicates by one-permutation MinHash: documents whose two-word shingle sets have a Jaccard similarity of 0.8.

One hash of every shingle serves all bins: its top bits name the bin, the least
hash in a bin is the bin's value. Bins that stay empty borrow from a bin that
has a value (optimal densification): each empty bin goes through all bins in a
random order of its own, the same for all documents, and takes the first that
is not empty. So every bin of two documents agrees with a probability of their
similarity, however short they are, and independently of the others.

Eight bins are a band, 64 bands are 64 buckets a set is put into. Two sets of
similarity 0.8 miss each other in all of them with a probability of
(1 - 0.8^8)^64 < 8e-6. Links are confirmed on the full sets.

Buckets offer stars, not pairs: every member is compared with one centre, so
there are at most as many candidates as sets. Members of one bucket that are
then still in different components get other centres in further rounds; links
among what is left after those are found by what members differ in from their
centre (`differences`), so that no link is lost to the star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm import differences
from changeflow.llm.common import mix, written
from changeflow.llm.differences import similar_pairs
from changeflow.llm.jaccard import components, shingles

SHINGLE = 2  # words
NUMERATOR, DENOMINATOR = 80, 100  # the least similarity
BIN_BITS, BAND = 9, 8  # 512 bins, eight to a band
BINS, BANDS = 1 << BIN_BITS, (1 << BIN_BITS) // BAND
STARS = 3  # rounds of comparisons with centres before differences
BROADCAST_ROWS = 1_000_000  # keys (16 bytes) sent to all executors, at most; more are joined by shuffle
BATCH = 1024  # documents whose bands are hashed together


def borrowing_order() -> np.ndarray:
    """For every bin, how early it asks each of the others: a fixed random order (equal figures: the lower bin)."""
    bins = np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    return (mix(bins) >> np.uint64(48)).astype(np.uint16).reshape(BINS, BINS)


def signature(tokens: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The values of all bins of a set of sorted, distinct 64-bit hashes that is not empty."""
    bins = (tokens >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.append(0, np.flatnonzero(np.diff(bins)) + 1)
    out, full = np.zeros(BINS, np.uint64), bins[first]
    out[full] = tokens[first]
    if len(full) < BINS:
        empty = np.setdiff1d(np.arange(BINS), full, assume_unique=True)
        out[empty] = out[full[order[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def bands(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, for every row of signatures."""
    parts = signatures.reshape(len(signatures), BANDS, BAND)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(BAND):
        out = mix(out ^ parts[:, :, i])
    return out


def node_of(tokens: np.ndarray) -> int:
    """A hash of the set."""
    node = np.bitwise_xor.reduce(mix(tokens ^ np.uint64(len(tokens)))) if len(tokens) else np.uint64(0)
    return int(np.array([node], np.uint64).view(np.int64)[0])


def _prints(docs: DataFrame) -> DataFrame:
    """`doc_id, th, node, n, buckets`; the buckets only where a task meets the set first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = borrowing_order(), set()
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                nodes, sizes, new, rows = [], [], [], []
                for i, text in enumerate(part.column(2)):
                    tokens = shingles(text.as_py(), SHINGLE)
                    node = node_of(tokens)
                    nodes.append(node)
                    sizes.append(len(tokens))
                    if len(tokens) and node not in seen:
                        seen.add(node)
                        new.append(i)
                        rows.append(signature(tokens, order))
                keys = bands(np.array(rows)).view(np.int64) if rows else None
                buckets: list = [None] * part.num_rows
                for at, i in enumerate(new):
                    buckets[i] = keys[at]
                columns = [part.column(0), part.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(buckets, pa.list_(pa.int64()))], names=["doc_id", "th", "node", "n", "buckets"]
                )

    ddl = "doc_id long, th long, node long, n long, buckets array<long>"
    return docs.select("doc_id", "th", "text").mapInArrow(run, ddl)


def _sets(docs: DataFrame) -> DataFrame:
    """`node, shingles` of the documents, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), SHINGLE) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) for s in sets], pa.int64()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["node", "shingles"],
            )

    return docs.select("text").mapInArrow(run, "node long, shingles array<long>")


def _small(keys: DataFrame) -> DataFrame:
    """A written table of keys, sent to all executors if it is small and joined by shuffle otherwise."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _open(spots: DataFrame, component: DataFrame | None) -> DataFrame:
    """Members of buckets that hold more than one component."""
    if component is not None:
        spots = spots.drop("component").join(component, "node", "left")
        spots = spots.withColumn("component", F.coalesce("component", "node"))
    several = spots.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return spots.join(several.filter("lo < hi").select("bucket"), "bucket", "left_semi")


def _sizes_allow(a: str, b: str):
    """Whether sets of these sizes can be similar enough."""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return DENOMINATOR * small >= NUMERATOR * large


def _star(spots: DataFrame, tried: DataFrame, turn: int) -> DataFrame:
    """At most one candidate `a, b` per set: it and the centre with which it shares most buckets.

    All buckets name their centres by one order, so the members of a group of
    copies meet the same few.
    """
    centre = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("at"), "node", "n", "component"))
    centres = spots.groupBy("bucket").agg(centre.alias("c")).select("bucket", "c.*")
    x, c = spots.alias("x"), centres.alias("c")
    pairs = x.join(c, "bucket").filter((F.col("x.component") != F.col("c.component")) & _sizes_allow("x", "c"))
    pairs = pairs.groupBy(
        F.least("x.node", "c.node").alias("a"), F.greatest("x.node", "c.node").alias("b"), F.col("x.node").alias("of")
    ).agg(F.count("*").alias("k"))
    pairs = pairs.join(tried, ["a", "b"], "left_anti")
    return pairs.groupBy("of").agg(F.max(F.struct("k", "a", "b")).alias("p")).select("p.a", "p.b").distinct()


def _components(spots: DataFrame, sets: DataFrame) -> DataFrame:
    """`node, component` of the sets that are linked with another one."""
    links = spots.sparkSession.createDataFrame([], "a long, b long")
    tried, component = links, None
    for turn in range(STARS):
        spots = written(_open(spots, component), "spots")
        pairs = written(_star(spots, tried, turn), "pairs")
        if pairs.isEmpty():
            break
        tried = tried.unionByName(pairs)
        links = written(links.unionByName(similar_pairs(pairs, sets, NUMERATOR, DENOMINATOR)), "links")
        component = components(links)
    rest = written(_open(spots, component), "spots")
    centres = rest.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node").alias("at"), "node")).alias("c"))
    members = rest.join(centres.select("bucket", F.col("c.node").alias("centre")), "bucket").filter("node <> centre")
    members = written(members.select("centre", "node", "component").distinct(), "members")
    if not members.isEmpty():
        links = links.unionByName(differences.links(members, sets, NUMERATOR, DENOMINATOR))
    return components(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept`, one row per row of `docs`.

    Lower-cased words (A-Z) between ASCII white space; sets of distinct
    two-word shingles, a single word being one shingle. Documents link at a
    Jaccard similarity of 0.8 of these sets; a component is called by its
    smallest `doc_id`, whose document is `kept`. Null and empty texts have no
    shingles, link with nothing and are kept. Null ids take part but name no
    component: such a row is kept only where no other id is in its component,
    which is then called null. Repeated rows stay repeated, and all rows with
    the component's id are kept. Sets are compared by 64-bit hashes; equal sets
    are one from the first pass on, so copies are never paired.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("th", F.xxhash64("text"))
    prints = written(_prints(docs), "prints")
    held = (
        prints.filter("buckets is not null").dropDuplicates(["node"])
        .select("node", "n", F.explode("buckets").alias("bucket")).withColumn("component", F.col("node"))
    )
    spots = written(_open(held, None), "spots")
    nodes = spots.select("node").distinct()
    # One document of each set that shares a bucket, to take the full set from.
    first = prints.join(nodes, "node", "left_semi").groupBy("node")
    first = first.agg(F.min(F.struct("doc_id", "th")).alias("d")).select("node", "d.*")
    first = _small(written(first, "first"))
    same = docs["doc_id"].eqNullSafe(first["doc_id"]) & (docs["th"] == first["th"])
    sets = written(_sets(docs.join(first, same, "left_semi")).dropDuplicates(["node"]), "sets")
    component = written(_components(spots, sets), "component")
    of = prints.select("doc_id", "node", "n").join(component, "node", "left")
    of = of.withColumn("component", F.coalesce("component", "node"))
    smallest = of.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("k"))
    smallest = smallest.filter("k > 1").select("component", "least")
    out = of.join(smallest, "component", "left")
    name = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("least", "doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), name.alias("component_id"),
        F.col("doc_id").eqNullSafe(name).alias("kept"),
    )
