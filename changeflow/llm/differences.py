"""Links between members of a star that its centre does not show: an exact join on what members differ in.

Let D(x) be the symmetric difference of a set x and the centre c. Then x and y
differ in |D(x)| + |D(y)| - 2 |D(x) & D(y)| elements, whatever c is, and a
Jaccard similarity of NUMERATOR / DENOMINATOR bounds that by a share of their
sizes. So D(x) and D(y) must have at least

    k = (G(x) + G(y)) / (2 S),  G(x) = S |D(x)| - R n(x),  S, R = DENOMINATOR +- NUMERATOR

elements in common, and at least one unless both are similar to c: if D(x) and
D(y) were disjoint and y not similar to c, then |D(x)| < R / S (n(x) - n(c)),
which is less than |D(x)|. Sets that are all close to c but not to each other
have differences of their own, so hardly any pair is offered; a join on what
they have in common would offer all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import written


def similar_pairs(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Those of the pairs `a, b` whose sets (`node, shingles`) are similar."""
    sides = sets.select("node", "shingles")
    joined = pairs.join(sides.toDF("a", "sa"), "a").join(sides.toDF("b", "sb"), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    similar = denominator * both >= numerator * (F.size("sa") + F.size("sb") - both)
    return joined.filter(similar).select("a", "b")


def links(members: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """All links `a, b` between two members of one star, and with its centre, that are in different components.

    `members` are distinct rows `centre, node, component`, the centre not among its own; `sets` has the full sets as
    `node, shingles`. Nodes of equal component are not compared.
    """
    total, rest = denominator + numerator, denominator - numerator
    sides = sets.select("node", "shingles")
    joined = members.join(sides.toDF("node", "sx"), "node").join(sides.toDF("centre", "sc"), "centre")
    more, less = F.array_except("sx", "sc"), F.array_except("sc", "sx")
    n, other = F.size("sx"), F.size("sc")
    both = n - F.size("more")
    rows = joined.withColumns({"more": more, "less": less}).select(
        "centre", "node", "component",
        (denominator * both >= numerator * (n + other - both)).alias("linked"),
        (total * (F.size("more") + F.size("less")) - rest * n).cast("long").alias("g"),
        F.concat("more", "less").alias("differs"),
    )
    rows = written(rows, "differences")
    direct = rows.filter("linked").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    tokens = rows.select("centre", "node", F.explode("differs").alias("token"))
    df = tokens.groupBy("centre", "token").agg(F.count("*").alias("df")).filter("df > 1")
    cores = (
        tokens.join(df, ["centre", "token"])
        .groupBy("centre", "node")  # at most the elements of two sets
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("core"))
        .join(rows.drop("differs"), ["centre", "node"])
        .withColumn("m", F.size("core"))
        .withColumn("h", 2 * total * F.col("m") - F.col("g"))
    )
    cores = written(cores, "cores")
    # A member similar to the centre can only add a link with one that is not.
    out = ~F.col("linked")
    bounds = cores.groupBy("centre").agg(
        F.min("g").alias("g_all"), F.max("h").alias("h_all"),
        F.min(F.when(out, F.col("g"))).alias("g_out"), F.max(F.when(out, F.col("h"))).alias("h_out"),
    )
    least_g, most_h = (F.when(F.col("linked"), F.col(f"{c}_out")).otherwise(F.col(f"{c}_all")) for c in "gh")
    k = F.greatest(F.lit(1), F.ceil((F.col("g") + least_g) / (2 * total)))
    short = (
        cores.join(bounds, "centre").filter((F.col("g") <= most_h) & (F.col("h") >= least_g))
        .withColumn("k", k).filter("m >= k")
        .select("centre", "node", "component", "linked", "g", "m", F.posexplode(F.slice("core", F.lit(1), F.col("m") - F.col("k") + 1)).alias("i", "e"))
        .select("centre", "node", "component", "linked", "g", (F.col("m") - F.col("i")).alias("left"), "e.token")
    )
    short = written(short, "short")
    x, y = short.alias("x"), short.alias("y")
    need = F.greatest(F.lit(1), F.ceil((F.col("x.g") + F.col("y.g")) / (2 * total)))
    pairs = x.join(y, ["centre", "token"]).filter(
        (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
        & ~(F.col("x.linked") & F.col("y.linked")) & (F.least("x.left", "y.left") >= need)
    )
    pairs = written(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "pairs")
    return direct.unionByName(similar_pairs(pairs, sets, numerator, denominator))
