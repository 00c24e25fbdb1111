"""Similarity join on word shingles: documents whose shingle sets have a Jaccard similarity of 0.75 or more.

Prefix filters under several global orders of all shingles. If two sets are
similar enough, then under *any* one order their prefixes (the first quarter
of the set and one more) share a shingle. Three orders are used in turn:

1. By hash, a longer prefix of which an eighth of the set must be shared with
   other documents. It takes one pass and sends a third of the shingles, six
   bytes each; most documents leave here.
2. By document frequency among the rest, rare first: prefixes hold what few
   documents share, so common passages make no candidates.
3. By another hash within coarse frequency classes. A pair must share a prefix
   shingle here too before its sets are compared.

Groups that share a shingle never expand into all pairs: members are compared
with the group's most central document first. Links among those that then still
lie in different components are found by what members differ in from one
another's centre (`differences`), which loses none of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import differences
from changeflow.llm.common import guarded, hashes, mix, words, written

SHINGLE = 5  # words
NUMERATOR, DENOMINATOR = 75, 100  # the least similarity
BUCKET_CHARS = 60_000_000  # characters of text whose prefix shingles meet in one bucket
BATCH_CHARS, BATCH_DOCS = 4_000_000, 60_000  # texts whose shingles are sorted together
BROADCAST_ROWS = 1_000_000  # document keys (16 bytes) sent to all executors, at most; more are joined by shuffle
ROUNDS = 4  # comparisons with central documents before pairs are enumerated
SEVERAL = 0xFFFF


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than `size` are one shingle."""
    h = hashes(words(text))
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = mix(out ^ h[i : n + i])
    return np.unique(out)


def least_overlap(n: np.ndarray) -> np.ndarray:
    """How many shingles a set of `n` shares with any similar one, at least."""
    return -(-n * NUMERATOR // DENOMINATOR)


def _prefixes(docs: DataFrame, buckets: int) -> DataFrame:
    """Header rows (`docs`) and shingle rows (`fps`, `refs`) of the first filter, per batch of documents.

    A shingle that several documents of a batch hold is counted for them at
    once and sent on once, so copies and common passages shrink before the
    shuffle.
    """
    ddl = (
        "bucket int, base long, fps binary, refs binary, "
        "docs array<struct<rn:long,doc_id:long,th:long,n:long,least:long,known:long>>"
    )
    entry = pa.struct([(c, pa.int64()) for c in ("rn", "doc_id", "th", "n", "least", "known")])
    names = ["bucket", "base", "fps", "refs", "docs"]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(entry)]

    def batch_rows(rows: list[tuple], base: int) -> pa.RecordBatch:
        sets = [shingles(text) for _, _, text in rows]
        n = np.array([len(s) for s in sets], np.int64)
        least = np.maximum(1, -(-n // 8))
        length = np.minimum(n, n - least_overlap(n) + least)
        tokens = np.concatenate([s[:k] for s, k in zip(sets, length, strict=True)])
        refs = np.repeat(np.arange(len(rows)), length)
        order = np.argsort(tokens, kind="stable")
        tokens, refs = tokens[order], refs[order]
        first = np.append(True, tokens[1:] != tokens[:-1])[: len(tokens)]
        starts = np.flatnonzero(first)
        many = np.diff(starts, append=len(tokens)) > 1
        known = np.bincount(refs[many[np.cumsum(first) - 1]], minlength=len(rows))
        sent, owner = mix(tokens[starts]), np.where(many, SEVERAL, refs[starts]).astype("<u2")
        bucket = (sent % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        prints, owner = (sent[by] >> np.uint64(32)).astype("<u4"), owner[by]
        edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
        header = [
            {"rn": base + i, "doc_id": d, "th": t, "n": int(n[i]), "least": int(least[i]), "known": int(known[i])}
            for i, (d, t, _) in enumerate(rows)
        ]
        out = [(None, base, None, None, header)]
        for b in range(buckets):
            lo, hi = edges[b], edges[b + 1]
            if hi > lo:
                out.append((b, base, prints[lo:hi].tobytes(), owner[lo:hi].tobytes(), None))
        columns = zip(*out, strict=True)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, rows, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            for cells in zip(*batch.columns, strict=True):
                row = tuple(c.as_py() for c in cells)
                rows.append(row)
                size += len(row[2] or "")
                if size >= BATCH_CHARS or len(rows) >= BATCH_DOCS:
                    yield batch_rows(rows, base)
                    base, rows, size = base + len(rows), [], 0
        if rows:
            yield batch_rows(rows, base)

    return docs.select("doc_id", "th", "text").mapInArrow(run, ddl)


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Per batch, the documents whose shingles in this bucket also came from another batch, as often as they did.

    Thirty-two bits and the bucket tell shingles apart here; a rare false match
    only lets a document stay that could have left.
    """
    edges = np.cumsum([0, *(len(f) // 4 for f in rows["fps"])])
    prints = np.frombuffer(b"".join(rows["fps"]), "<u4")
    refs = np.frombuffer(b"".join(rows["refs"]), "<u2")
    order = np.argsort(prints, kind="stable")
    equal = prints[order][1:] == prints[order][:-1]
    twin = np.zeros(len(prints), bool)
    twin[order] = (np.append(equal, False) | np.append(False, equal))[: len(order)]
    twin &= refs != SEVERAL
    parts = [refs[lo:hi][twin[lo:hi]].tobytes() for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
    return pd.DataFrame({"base": rows["base"], "refs": parts})[[len(x) > 0 for x in parts]]


def _counted(rows: pd.DataFrame) -> pd.DataFrame:
    """`rn, hits` of one batch's documents from what all buckets found."""
    hits = np.bincount(np.frombuffer(b"".join(rows["refs"]), "<u2"))
    at = np.flatnonzero(hits)
    return pd.DataFrame({"rn": int(rows["base"].iloc[0]) + at, "hits": hits[at]})


def _sets(docs: DataFrame) -> DataFrame:
    """`doc_id, th, node, n, shingles`; the set only where a task meets it first. `node` is a hash of the set."""
    ddl = "doc_id long, th long, node long, n long, shingles array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            nodes, sizes, sets = [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py())
                node = int(np.bitwise_xor.reduce(mix(s ^ np.uint64(len(s))))) if len(s) else 0
                node = int(np.array([node], np.uint64).view(np.int64)[0])
                nodes.append(node)
                sizes.append(len(s))
                sets.append(None if node in seen else s.view(np.int64))
                seen.add(node)
            columns = [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "th", "node", "n", "shingles"]
            )

    return docs.select("doc_id", "th", "text").mapInArrow(run, ddl)


def components(links: DataFrame) -> DataFrame:
    """`node, component` of the graph with the edges `a, b`; a component is called by its smallest node.

    Alternating star contraction: every step links nodes to the smallest
    neighbour known so far, from above and from below, until nothing changes.
    Only aggregates and joins on the edge table; a node with any number of
    neighbours is met by map-side aggregation and a join that can be split.
    """

    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))

    def large(edges: DataFrame) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        return both.join(smallest(both), "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))

    def small(edges: DataFrame) -> DataFrame:
        down = edges.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u"))
        low = smallest(down)
        return (
            down.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(low.select("v", F.col("m").alias("u")))
            .filter("v <> u")
        )

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u"))).first())

    edges = written(links.select(F.col("a").alias("v"), F.col("b").alias("u")).filter("v <> u").distinct(), "edges")
    before = state(edges)
    while before[0]:
        edges = written(small(large(edges).distinct()).distinct(), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component"))


def _orders(cores: DataFrame) -> DataFrame:
    """`rare` and `mixed`: the prefixes under the second and third order, as far as other documents can hold them.

    Shingles that no other document has come first in both orders and match
    nothing, so only what the prefix holds beyond them is kept.
    """
    kept = F.size("shared") - F.col("least") + 1

    def prefix(order: Column) -> Column:
        return F.transform(F.slice(F.array_sort(order), F.lit(1), kept), lambda x: x["token"])

    coarse = F.transform(
        "shared",
        lambda x: F.struct(F.floor(F.log2(x["df"])).alias("c"), F.xxhash64(x["token"]).alias("h"), x["token"].alias("token")),
    )
    return cores.withColumns({"rare": prefix(F.col("shared")), "mixed": prefix(coarse)})


def _may_match(a: str, b: str) -> Column:
    """Whether the rows `a, b` of one shingle may be where two similar documents meet first.

    Bounds from sizes: what one of them shares with anyone must be enough; and
    if this is the first shingle they have in common, then so must be what
    stands from here on in both. It is not the first one if the shingles
    before it are the same, so a pair has few rows of the many it could have.
    """
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    rest = F.least(f"{a}.m", f"{b}.m", F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    same = F.coalesce(F.col(f"{a}.prior") == F.col(f"{b}.prior"), F.lit(False))
    return (DENOMINATOR * rest >= NUMERATOR * (n - rest)) & ~same


def _verify(pairs: DataFrame, cores: DataFrame) -> DataFrame:
    """Those of the pairs `a, b` that share a prefix shingle under both orders and are similar."""
    tokens = F.transform("shared", lambda x: x["token"])
    sides = cores.select("node", "n", "rare", "mixed", tokens.alias("tokens"))
    joined = pairs.join(sides.toDF("a", "na", "ra", "ma", "ta"), "a").join(sides.toDF("b", "nb", "rb", "mb", "tb"), "b")
    both = F.size(F.array_intersect("ta", "tb"))
    similar = DENOMINATOR * both >= NUMERATOR * (F.col("na") + F.col("nb") - both)
    return (
        joined.filter(F.arrays_overlap("ra", "rb") & F.arrays_overlap("ma", "mb")).filter(similar).select("a", "b")
    )


def _links(cores: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links `a, b` with the components of the similarity graph over `node, n, least, shared`."""
    spark = cores.sparkSession
    sized = cores.select("node", "n", F.size("shared").cast("long").alias("m"), "rare")
    held = sized.select("node", "n", "m", "rare", F.posexplode("rare").alias("i", "token")).select(
        "node", "n", "m", "token",
        (F.col("n") - F.col("m") + F.col("i")).alias("at"),  # behind all shingles of its own
        F.get("rare", F.col("i") - 1).alias("prior"),
    )
    links = spark.createDataFrame([], "a long, b long")
    tried, component = links, None
    for turn in range(ROUNDS):
        rough = _spots(held, component)
        # Of the documents that share a shingle, the one with the fewest shingles of its own is likest to all. Those
        # that it is not like meet others in later rounds.
        first = F.xxhash64("node", F.lit(turn)) if turn else (1 - F.col("m") / F.col("n"))
        centre = F.struct(first.alias("alone"), "node", "n", "m", "at", "prior", "component")
        best = rough.groupBy("token").agg(F.min(centre).alias("c"))
        pairs = rough.alias("x").join(best.select("token", "c.*").alias("c"), "token")
        pairs = pairs.filter((F.col("x.component") != F.col("c.component")) & _may_match("x", "c"))
        pairs = pairs.groupBy(
            F.least("x.node", "c.node").alias("a"), F.greatest("x.node", "c.node").alias("b"), F.col("x.node").alias("of")
        ).agg(F.count("*").alias("k"))
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
        # One comparison per document and round, with the centre it shares most with.
        pairs = pairs.groupBy("of").agg(F.max(F.struct("k", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            break
        tried = tried.unionByName(pairs)
        links = written(links.unionByName(_verify(pairs, cores)), "links")
        component = components(links)
    spots = _spots(held, component)
    centres = spots.groupBy("token").agg(F.min(F.struct(F.xxhash64("node").alias("at"), "node")).alias("c"))
    members = spots.join(centres.select("token", F.col("c.node").alias("centre")), "token").filter("node <> centre")
    members = written(members.select("centre", "node", "component").distinct(), "members")
    if members.isEmpty():
        return links
    return links.unionByName(differences.links(members, nodes, NUMERATOR, DENOMINATOR))


def _spots(held: DataFrame, component: DataFrame | None) -> DataFrame:
    """Prefix shingles that documents of more than one component hold, one row per document and shingle."""
    if component is None:
        named = held.withColumn("component", F.col("node"))
    else:
        named = held.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return written(named.join(several.select("token"), "token", "left_semi"), "spots")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id`, one row per row of `docs`.

    Lower-cased words (A-Z) between ASCII white space; sets of distinct
    five-word shingles, fewer words being one shingle. Documents link at a
    Jaccard similarity of 0.75; a component is called by its smallest
    `doc_id`. Null and empty texts have no shingles and link with nothing.
    Null ids take part but name no component (null, if it has no other).
    Repeated rows stay repeated. Sets are compared by 64-bit hashes.

    Shuffled: about 6 bytes for each of a third of all shingles, then the sets
    of documents that share much with others. No step holds all documents that
    share a shingle, a passage or a text in one task.
    """
    return _members(docs).select("doc_id", "n_shingles", "component_id")


def _members(docs: DataFrame) -> DataFrame:
    """What `near_duplicates` returns, with `th`, the hash of the text."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("th", F.xxhash64("text"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    first = written(_prefixes(docs, max(1, math.ceil(chars / BUCKET_CHARS))), "prefixes")
    every = first.filter("docs is not null").select(F.inline("docs"))
    hits = (
        first.filter("bucket is not null").select("bucket", "base", "fps", "refs")
        .groupBy("bucket").applyInPandas(_shared, "base long, refs binary")
        .groupBy("base").applyInPandas(_counted, "rn long, hits long")
    )
    stays = every.join(hits, "rn", "left").filter(
        (F.col("n") > 0) & (F.col("known") + F.coalesce("hits", F.lit(0)) >= F.col("least"))
    )
    listed = _listed(written(stays.select("doc_id", "th").distinct(), "stays"))
    same = docs["doc_id"].eqNullSafe(listed["doc_id"]) & (docs["th"] == listed["th"])
    sets = written(_sets(docs.join(listed, same, "left_semi")), "sets")
    nodes = sets.filter("shingles is not null").select("node", "n", "shingles").dropDuplicates(["node"])
    nodes = written(nodes, "nodes")
    component = _similar(spark, nodes)
    of = sets.select("doc_id", "th", "node").distinct().join(component, "node", "left")
    of = of.withColumn("component", F.coalesce("component", "node"))
    smallest = of.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of = written(of.join(smallest, "component").select("doc_id", "th", "component_id"), "of")
    out = every.alias("e").join(
        of.withColumn("found", F.lit(True)).alias("o"),
        F.col("e.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("e.th") == F.col("o.th")),
        "left",
    )
    return out.select(
        "e.doc_id",
        "e.th",
        F.col("e.n").alias("n_shingles"),
        F.when(F.col("o.found"), F.col("o.component_id")).otherwise(F.col("e.doc_id")).alias("component_id"),
    )


def _similar(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """`node, component` of all nodes that are linked with another one."""
    tokens = nodes.select("node", "n", F.explode("shingles").alias("token"))
    df = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    cores = (
        tokens.join(df, "token")
        .groupBy("node")  # at most a document's own shingles
        .agg(F.first("n").alias("n"), F.collect_list(F.struct("df", "token")).alias("shared"))
        .withColumn("least", F.ceil(F.col("n") * NUMERATOR / DENOMINATOR))
        .filter(F.size("shared") >= F.col("least"))
    )
    cores = written(_orders(cores), "cores")
    return components(_links(cores, nodes))


def _listed(keys: DataFrame) -> DataFrame:
    """A written table of document keys, sent to all executors if it is small and joined by shuffle otherwise."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id, with its own columns.

    Of rows that repeat an id and a text one stays. Documents without text,
    which link with nothing, all stay. A row without an id goes if it is
    linked with one that has an id.
    """
    safe, back = guarded(docs)
    named = safe.withColumns(
        {"doc_id": F.col(f"_{docs.columns.index('doc_id')}").cast("long"), "th": F.xxhash64("text")}
    )
    of = _members(named.select("doc_id", "text")).filter("n_shingles > 0").groupBy("doc_id", "th")
    of = of.agg(F.first("component_id").alias("component_id"), F.count("*").alias("rows"))
    of = of.withColumn("gone", ~F.col("doc_id").eqNullSafe(F.col("component_id"))).filter("gone or rows > 1")
    listed = _listed(written(of.select("doc_id", "th", "gone"), "gone"))
    listed = listed.toDF("gone_id", "gone_th", "gone")
    same = named["doc_id"].eqNullSafe(listed["gone_id"]) & (named["th"] == listed["gone_th"])
    joined = named.join(listed, same, "left")
    alone = joined.filter("gone is null")
    repeated = joined.filter("not gone").dropDuplicates(["doc_id", "th"])
    return back(alone.unionByName(repeated))
