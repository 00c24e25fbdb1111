"""Licence scan: which licence notices a text contains. DataFrame functions only.

MinHash bands of overlapping windows retrieve templates; the share of a
template's shingles that the whole text holds decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import license_texts
from changeflow.llm.common import written

SHINGLE = 5  # words
CONTAINED = 0.75  # of a template's shingles
WINDOW = 2  # shingles of a text's window, so six words; windows start at every shingle and one before the first
# One hash a band: under each seed a window keeps its least hash, a template all of its own. A shared shingle is in two
# windows and is missed under a seed if its hash is greater than both neighbours', with 1/3; under all of them with
# 3^-8 < 0.00016. The first and the last shingle of a text have a window of their own and are never missed.
BANDS = 8
BROADCAST_ROWS = 500_000  # band keys of templates, or keys of documents (24 bytes each), sent to executors, at most


def notices(spark: SparkSession, texts: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """`template, text` of the given notices, of those of `license_texts` by default."""
    rows = [F.struct(F.lit(name).alias("template"), F.lit(text).alias("text")) for name, text in texts or license_texts.notices()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def tokens(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits; one empty word for a text without any."""
    return F.split(F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", F.lit(" "))), " ")


def grams(text: Column, widths: list[int]) -> Column:
    """For each of the ascending `widths` the hashes of all runs of so many words, in order, repeats included."""

    def grown(hashed: Column, w: Column, n: int) -> Column:
        # The last entries run past the end; they are cut off.
        whole = F.slice(hashed, F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(0)))
        if n == widths[-1]:
            return F.array(whole)
        longer = F.zip_with(hashed, F.slice(w, F.lit(n + 1), F.lit(1 << 30)), lambda a, b: F.xxhash64(a, b))
        rest = F.transform(F.array(longer), lambda h: grown(h, w, n + 1))[0]
        return F.concat(F.array(whole), rest) if n in widths else rest

    def chained(w: Column) -> Column:
        first = F.transform(w, lambda x: F.xxhash64(x))
        return F.transform(F.array(first), lambda h: grown(h, w, 1))[0]

    return F.transform(F.array(tokens(text)), chained)[0]


def bands(texts: DataFrame, widths: list[int]) -> DataFrame:
    """The band keys of all windows over the column `grams`, one row each: a window's least hash under each seed.

    Runs of fewer than five words, for templates that have no more, are keys
    themselves. Windows and seeds are rows that live inside one generated
    loop, not arrays: nothing is materialised before the keys are joined. An
    outer explode keeps the optimizer from computing the grams once more in a
    filter.
    """
    last = F.size(F.get("grams", F.lit(0))) - 1  # the shortest width has the most runs
    starts = F.sequence(F.lit(1 - WINDOW), F.greatest(last, F.lit(1 - WINDOW)))
    windows = texts.withColumn("start", F.explode_outer(starts))
    seeds = [*range(BANDS), *[-n for n in widths if n < SHINGLE]]
    seeded = windows.withColumn("seed", F.explode_outer(F.array(*[F.lit(s) for s in seeds])))
    key = F.least(*[_keyed(F.get(F.get("grams", F.lit(len(widths) - 1)), F.col("start") + i)) for i in range(WINDOW)])
    for i, n in enumerate(widths):
        if n < SHINGLE:
            key = F.when(F.col("seed") == -n, _keyed(F.get(F.get("grams", F.lit(i)), F.col("start")))).otherwise(key)
    return seeded.withColumn("key", key).drop("grams", "start", "seed")


def _keyed(x: Column) -> Column:
    return F.when(x.isNotNull(), F.xxhash64(x, "seed"))


def _template_keys(known: DataFrame) -> DataFrame:
    """`template, key`: every shingle under every seed; of a short template its one run of words."""
    seeds = F.when(F.col("width") < SHINGLE, F.array(-F.col("width"))).otherwise(F.array(*[F.lit(s) for s in range(BANDS)]))
    rows = known.select("template", "width", F.explode("own").alias("h")).withColumn("seed", F.explode(seeds))
    return rows.select("template", _keyed(F.col("h")).alias("key")).distinct()


def _small(frame: DataFrame) -> DataFrame:
    """A written table, sent to all executors if it has few rows and joined by shuffle otherwise."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """`doc_id, template, n_shared, n_template, containment`, a row per document and template it contains.

    A template is contained if the text holds `CONTAINED` of its distinct
    shingles; one of fewer than five words is one shingle of all its words.
    `templates` has `template` (one row a name) and `text`; those without a word are never found.
    Null and empty texts contain nothing. A row that repeats an id and a text
    is one document; rows that repeat an id with another text are documents of
    their own. Null ids take part and stay null.

    Windows of a text never leave its row before they have met the band keys;
    only documents with a hit are read a second time.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("th", F.xxhash64("text"))
    every = list(range(1, SHINGLE + 1))
    words = tokens(F.col("text"))
    known = templates.select("template", "text", F.least(F.size(words), F.lit(SHINGLE)).alias("width")).filter(words[0] != "")
    own = F.array_distinct(F.get(grams(F.col("text"), every), F.col("width") - 1))
    known = written(known.select("template", "width", own.alias("own")), "templates")
    widths = sorted({r["width"] for r in known.select("width").distinct().collect()} | {SHINGLE})  # five at most
    keys = written(_template_keys(known), "keys")
    texts = docs.select("doc_id", "th", grams(F.col("text"), widths).alias("grams"))
    met = bands(texts, widths).join(_small(keys), "key")
    hits = written(met.select("doc_id", "th", "template").distinct(), "hits")
    listed = _small(written(hits.select("doc_id", "th").distinct(), "listed"))
    same = docs["doc_id"].eqNullSafe(listed["doc_id"]) & (docs["th"] == listed["th"])
    held = F.array_distinct(F.flatten(grams(F.col("text"), widths)))
    held = docs.join(listed, same, "left_semi").select("doc_id", "th", held.alias("held"))
    held = held.dropDuplicates(["doc_id", "th"]).alias("d")
    pairs = held.join(
        hits.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.th") == F.col("h.th"))
    ).join(_small(known.select("template", "own")), "template")
    shared = F.size(F.array_intersect("own", "held"))
    return (
        pairs.select(
            "d.doc_id", "template", shared.cast("long").alias("n_shared"), F.size("own").cast("long").alias("n_template")
        )
        .withColumn("containment", F.col("n_shared") / F.col("n_template"))
        .filter(F.col("containment") >= CONTAINED)
    )
