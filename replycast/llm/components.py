"""Connected components of links, by contracting them until none is left."""

from pyspark.sql import functions as F

from .common import saved


def _oriented(links):
    """Links between different nodes, the smaller one first, each once."""
    return (
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b")
        .distinct()
    )


def _drawn(node, number):
    """A node with its place in the order of a round, to be compared."""
    return F.struct(F.xxhash64(F.lit(number), node).alias("draw"), F.col(node).alias("node"))


def components(links):
    """`node` and `root` for every node of the links `a`, `b`; `root` is one node of its component.

    In every round nodes are put in a new random order. Each points to the first of its neighbours and
    itself, and from there on to that one's own choice; links then join the nodes pointed to. The random
    order keeps chains short, so the number of rounds grows with the logarithm of the longest path. Only
    narrow tables move, nothing is collected, and each round's tables are written, so a lost executor
    costs one round at most.
    """
    links, roots, number = saved(_oriented(links)), None, 0
    while not links.isEmpty():
        number += 1
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min(_drawn("b", number))
        nearest = both.groupBy(F.col("a").alias("node")).agg(first.alias("first"))
        own = _drawn("node", number) < F.col("first")
        nearest = saved(
            nearest.select("node", F.when(own, F.col("node")).otherwise(F.col("first.node")).alias("next"))
        )
        second = nearest.select(F.col("node").alias("next"), F.col("next").alias("root"))
        steps = saved(nearest.join(second, "next").select("node", "root"))
        if roots is None:
            roots = steps
        else:
            onward = steps.select(F.col("node").alias("root"), F.col("root").alias("onward"))
            roots = saved(
                roots.join(onward, "root", "left").select(
                    "node", F.coalesce("onward", "root").alias("root")
                )
            )
        ends = {
            end: steps.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
            for end in "ab"
        }
        links = saved(
            _oriented(
                links.join(ends["a"], "a")
                .join(ends["b"], "b")
                .select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
            )
        )
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
