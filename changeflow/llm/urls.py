"""URL filter: fixed rules, and per host a tree of path templates judged by the labels that fall into them.

Segments that vary become wildcards, branches that behave alike are merged,
and a template is rejected if the smoothed share of its labelled URLs that are
to be blocked is high; templates with few or no labels lean on those above
them, and on the same template of all hosts. Everything is an aggregate over
counted paths.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import written

#: The rules of the contract: verdict, then host and path.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)

VARIABLE_CHILDREN = 8  # a node with at least so many rare children has a variable segment
RARE_SHARE = 0.02  # a child with a smaller share of its node's URLs is rare
ALIKE_Z = 1.96  # branches whose blocked shares differ by less (standard errors) are merged
SMOOTHING = 10.0  # how many labelled URLs the share that a template backs off to counts as
PRIOR = 0.5  # the share where no template that begins alike has labels on any host: nothing is rejected there
BLOCK_SHARE = 0.7  # smoothed share of blocked ones from which a template is rejected
BROADCAST_ROWS = 200_000  # templates sent to all executors, at most
SALTS = 16


def located(urls: DataFrame, url: str = "url") -> DataFrame:
    """`host` and `path` beside the columns of `urls`. Null, and URLs without `://`, have neither: both are empty."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return urls.withColumns(
        {"host": F.translate(F.regexp_extract(text, pattern, 1), upper, lower), "path": F.regexp_extract(text, pattern, 2)}
    )


def ruled(rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits `host` and `path`, and its verdict; null if none does.

    A rule fits its host and all subdomains where the path starts with the
    rule's. Of equally long ones the first by name holds.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        host, slash, path = text.partition("/")
        inside = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = inside & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def shapes(path: Column) -> Column:
    """The segments of a path with numbers, hexadecimal ids and dates made general."""
    kinds = (
        (r"[0-9]{4}-[0-9]{2}(-[0-9]{2})?", "<date>"),
        (r"[0-9a-fA-F]{8}-[0-9a-fA-F-]{27}|(?=[0-9a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{16,}", "<id>"),
        (r"[0-9]+", "<n>"),
    )

    def shape(segment: Column) -> Column:
        for pattern, name in kinds:
            segment = F.regexp_replace(segment, rf"(?<![\p{{L}}0-9<])(?:{pattern})(?![\p{{L}}0-9>])", name)
        return segment

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), shape)


def templates(counted: DataFrame) -> DataFrame:
    """`host, shape` with `template`, from rows `host, shape, n, blocked, allowed` with one row per host and shape.

    Level by level: under a node that has at least `VARIABLE_CHILDREN` rare
    children those become `*`. A node with fewer shapes below it can have no
    such node below it, so its shapes are finished as they are; the levels go
    on until no other node is left, however deep. Counts are summed per node
    and child first, so neither a large host nor a node with many children
    meets in one task.
    """
    open_, done, level = counted.select("host", "shape", "n", F.array().cast("array<string>").alias("template")), [], 0
    rest = F.slice("shape", F.size("template") + 1, F.lit(1 << 30))
    while True:
        # Nodes that may still branch; the last segment of a shape ends it.
        nodes = open_.groupBy("host", "template").agg(F.count("*").alias("shapes"), F.sum("n").alias("total"))
        part = open_.join(nodes, ["host", "template"])
        ends = (F.col("shapes") < VARIABLE_CHILDREN) | (F.size("shape") <= level)
        part = written(part.withColumn("ends", ends), "tree")  # levels do not pile up in one plan
        done.append(part.filter("ends").select("host", "shape", F.concat("template", rest).alias("template")))
        part = part.filter("not ends").withColumn("segment", F.get("shape", F.lit(level)))
        if part.isEmpty():
            return reduce(DataFrame.unionByName, done)
        children = part.groupBy("host", "template", "segment").agg(F.sum("n").alias("n"), F.first("total").alias("total"))
        rare = children.filter(F.col("n") < RARE_SHARE * F.col("total"))
        wide = rare.groupBy("host", "template").agg(F.count("*").alias("k")).filter(F.col("k") >= VARIABLE_CHILDREN)
        general = rare.join(wide, ["host", "template"], "left_semi").select("host", "template", "segment")
        open_ = part.join(general.withColumn("star", F.lit("*")), ["host", "template", "segment"], "left").select(
            "host", "shape", "n", F.concat("template", F.array(F.coalesce("star", "segment"))).alias("template")
        )
        level += 1


def _prefixes(frame: DataFrame) -> DataFrame:
    """A row per beginning of `template`: its length `k` and its hash `node`."""
    beginnings = F.transform("template", lambda _, i: F.xxhash64(F.slice(F.col("template"), F.lit(1), i + 1)))
    return frame.select("*", F.posexplode(beginnings).alias("k", "node"))


def backed_off(labelled: DataFrame) -> DataFrame:
    """`host, template, purity` from `host, template, blocked, seen`, one row a template; `own` and `of` are its branch's.

    The share of blocked ones is smoothed from the general to the special:
    from `PRIOR` through the beginnings of the template over all hosts, then
    through its beginnings on its own host, then its branch. Each step counts
    the share before it as `SMOOTHING` URLs, so a step without labels changes
    nothing. The empty beginning takes no part: that some of a host is
    labelled says nothing about the rest of it.
    """
    nodes = _prefixes(labelled.filter("seen > 0").select("host", "template", "blocked", "seen"))
    by_host = nodes.groupBy("host", "k", "node").agg(F.sum("blocked").alias("hb"), F.sum("seen").alias("hs"))
    by_host = written(by_host, "nodes")
    anywhere = by_host.groupBy("k", "node").agg(F.sum("hb").alias("gb"), F.sum("hs").alias("gs"))
    steps = _prefixes(labelled.select("host", "template"))
    steps = steps.join(by_host, ["host", "k", "node"], "left").join(anywhere, ["k", "node"], "left").na.fill(0)
    chain = F.sort_array(F.collect_list(F.struct("k", "hb", "hs", "gb", "gs"))).alias("chain")
    chains = steps.groupBy("host", "template").agg(chain)
    joined = labelled.join(chains, ["host", "template"], "left")

    def smoothed(share: Column, blocked: Column, seen: Column) -> Column:
        return (blocked + SMOOTHING * share) / (seen + SMOOTHING)

    chain = F.coalesce("chain", F.array().cast(chains.schema["chain"].dataType))
    general = F.aggregate(chain, F.lit(PRIOR), lambda share, s: smoothed(share, s["gb"], s["gs"]))
    above = F.slice(chain, F.lit(1), F.greatest(F.size(chain) - 1, F.lit(0)))  # the last one is the template, so the branch
    hosted = F.aggregate(above, general, lambda share, s: smoothed(share, s["hb"], s["hs"]))
    return joined.select("host", "template", smoothed(hosted, F.col("own"), F.col("of")).alias("purity"))


def judged(counted: DataFrame, named: DataFrame) -> DataFrame:
    """`host, template, branch, n, blocked, allowed, purity, rejected` of every template.

    `branch` is the template with its first fixed segment replaced by `~`
    where the branches of that place are alike: the same template otherwise,
    and blocked shares within `ALIKE_Z` standard errors of their common one.
    Their labels then count together. A branch without labels is not like any
    other. `purity` is the blocked share of the branch, smoothed by `backed_off`.
    """
    sums = (
        counted.join(named, ["host", "shape"]).groupBy("host", "template")
        .agg(*[F.sum(c).alias(c) for c in ("n", "blocked", "allowed")])
    )
    seen = F.col("blocked") + F.col("allowed")
    place = F.array_position(F.transform("template", lambda s: (s != "*") & ~F.contains(s, F.lit("<"))), True)
    family = F.transform("template", lambda s, i: F.when(i + 1 == place, F.lit("~")).otherwise(s))
    sums = sums.withColumns({"family": family, "seen": seen})
    pooled = (
        sums.filter("seen > 0").groupBy("host", "family")
        .agg(F.sum("blocked").alias("fb"), F.sum("seen").alias("fs"), F.count("*").alias("members"))
    )
    rate = F.col("fb") / F.col("fs")
    error = F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-9)) / F.col("seen"))
    alike = F.coalesce((F.abs(F.col("blocked") / F.nullif("seen", F.lit(0)) - rate) <= ALIKE_Z * error), F.lit(False))
    parts = sums.join(pooled, ["host", "family"], "left").withColumn("alike", alike & (F.col("members") > 1))
    parts = parts.withColumn("branch", F.when(F.col("alike"), F.col("family")).otherwise(F.col("template")))
    parts = written(parts, "parts")
    merged = parts.groupBy("host", "branch").agg(F.sum("blocked").alias("own"), F.sum("seen").alias("of"))
    purities = backed_off(parts.join(merged, ["host", "branch"]))
    return parts.join(purities, ["host", "template"]).select(
        "host", "template", "branch", "n", "blocked", "allowed", "purity",
        (F.col("purity") >= BLOCK_SHARE).alias("rejected"),
    )


def verdicts(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """`page_id, host, path, rule, verdict, template, purity`, one row per row of `pages`.

    The rule's verdict holds; without a rule the page's template decides:
    `block` if it is rejected. The tree learns from the URLs that rules judge.
    Pages are counted per host and shape before anything else, and templates
    are sent to all executors where they are few; otherwise pages join them by
    shuffle, dealt to `SALTS` parts so that no template's pages meet in one task.
    """
    rule, verdict = ruled(rules)
    rows = located(pages.select("page_id", "url")).withColumns({"rule": rule, "ruled": verdict})
    rows = rows.withColumn("shape", shapes(F.col("path")))
    counted = rows.groupBy("host", "shape").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("ruled") == "block").alias("blocked"),
        F.count_if(F.col("ruled") == "allow").alias("allowed"),
    )
    counted = written(counted, "shapes")
    named = written(templates(counted), "named")
    known = named.join(judged(counted, named), ["host", "template"]).select("host", "shape", "template", "purity", "rejected")
    known = written(known, "templates")
    if known.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(known), ["host", "shape"], "left")
    else:
        salts = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = salted.join(salts, ["host", "shape", "salt"], "left")
    own = F.when(F.col("rejected"), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity",
    )
