"""Pairs of rows that share a key and pass a check, without all pairs of a large group."""

from pyspark.sql import functions as F

from .common import saved_alone

ID = ("h1", "h2")
#: Groups of up to this many rows are paired at once.
FEW = 16


def _ends(side, ids):
    """Names of an id's columns on a side of a pair: a1, a2, ..."""
    return [f"{side}{n}" for n in range(1, len(ids) + 1)]


def _side(rows, name, ids):
    return rows.select(
        "key", F.col("n").alias(f"{name}_n"), *(F.col(c).alias(end) for c, end in zip(ids, _ends(name, ids)))
    )


def _ordered(pairs, ids, *more):
    """Pairs of different ids with the smaller one first."""
    x, y = (F.struct(*_ends(side, ids)) for side in "xy")
    pairs = pairs.filter(x != y).withColumn("swap", x > y)
    columns = [
        F.when(F.col("swap"), one).otherwise(other).alias(name)
        for side, ones, others in (("a", "y", "x"), ("b", "x", "y"))
        for name, one, other in zip(_ends(side, ids), map(F.col, _ends(ones, ids)), map(F.col, _ends(others, ids)))
    ]
    return pairs.select(*more, *columns)


def checked_pairs(entries, check, ratio, order=None, ids=ID):
    """Pairs `a1`, ..., `b1`, ... of ids that share a key of `entries` (key, the `ids`, n) and pass `check`.

    `n` is a row's size; pairs whose smaller size is under `ratio` of the larger one are left out. Keys of
    one row alone go first, by a count that carries no ids. In a large group all rows are checked against
    its first one, by `order` (the `ids`, first), or else by id. Rows that pass need no other pair among
    themselves: they are linked through the first one, which comes before them. The others are checked
    against all rows of the group, so no pair with one of them is lost. Ids and keys are not null; without
    entries there are no pairs.
    """
    ids = list(ids)
    pair, x_ends = _ends("a", ids) + _ends("b", ids), _ends("x", ids)
    sizes = entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    groups = saved_alone(entries.join(sizes, "key"))
    sized = F.least("x_n", "y_n") >= ratio * F.greatest("x_n", "y_n") - 1e-6

    def met(x, y):
        return x.join(y, "key").filter(sized)

    few = groups.filter(F.col("size") <= FEW)
    pairs = _ordered(met(_side(few, "x", ids), _side(few, "y", ids)), ids)
    large = groups.filter(F.col("size") > FEW)
    if large.isEmpty():
        return check(pairs.distinct())
    placed = large.join(order, ids) if order is not None else large.withColumn("first", F.lit(0))
    firsts = saved_alone(placed.groupBy("key").agg(F.min(F.struct("first", *ids, "n")).alias("p")))
    firsts = firsts.select("key", *(F.col(f"p.{c}").alias(y) for c, y in zip(ids, _ends("y", ids))), "p.n")
    firsts = firsts.withColumnRenamed("n", "y_n")
    star = _ordered(met(_side(large, "x", ids), firsts), ids, "key", *x_ends)
    near = saved_alone(check(pairs.unionByName(star.drop("key", *x_ends)).distinct()))
    settled = star.join(near, pair).select("key", *x_ends)
    settled = settled.unionByName(firsts.select("key", *(F.col(f"y{x[1:]}").alias(x) for x in x_ends)))
    others = saved_alone(_side(large, "x", ids).join(settled, ["key", *x_ends], "left_anti"))
    more = _ordered(met(others, _side(large, "y", ids)), ids).distinct()
    return near.unionByName(check(more.join(near, pair, "left_anti")))
