"""Mixing sources to target weights: capped water-filling and seeded repetitions.

A null source is a source of its own; a null text has size 0. Sources without a weight, or with a weight
that is null or not above 0, get no target. Sizes of 0 are taken 0 times over in words, but such rows
follow the whole repetitions of their source. Repeated rows are drawn apart from each other. An empty
table gives an empty table. Only the named columns are read.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import row_hashes, saved, words

BUCKETS = 1024


def targets(sizes, max_epochs=3.0, total=None):
    """Words to take from each source: `sizes` (source, size, weight) with a column `target`.

    Every round deals what is left to the sources not yet clamped, by weight, and clamps those whose
    share is above `max_epochs` times their size, until none is. A round reads two sums of the table of
    sources; the table itself stays with the executors. `total` defaults to the sum of all sizes; if
    it is more than all sources can give, each gives its most.
    """
    cap = F.col("size") * F.lit(float(max_epochs))
    weight = F.when(F.col("weight") > 0, F.col("weight").cast("double")).otherwise(F.lit(0.0))
    sizes = sizes.select("source", "size", weight.alias("weight"), cap.alias("cap"))
    if total is None:
        total = sizes.agg(F.sum("size")).first()[0] or 0
    level, clamped = 0.0, -1
    while True:
        # a source is clamped as long as its share at this level is above its cap; levels only rise
        over = F.col("weight") * F.lit(level) > F.col("cap")
        free, full, n = sizes.agg(
            F.sum(F.when(~over, F.col("weight"))),
            F.sum(F.when(over, F.col("cap"))),
            F.count(F.when(over, 1)),
        ).first()
        if n == clamped or not free:
            break
        level, clamped = (total - (full or 0.0)) / free, n
    return sizes.select(
        "source", "size", F.least(F.col("weight") * F.lit(level), F.col("cap")).alias("target")
    )


def _copies(rows, goals, seed):
    """Repetitions of each row: the whole ones, and one more for a seeded part of its source.

    The rows of a source are ordered by a seeded hash. Sums of the hash's buckets, then running sums
    within a bucket give the words that precede a row, so no task holds a whole source. The rows whose
    middle lies before the fractional part of the target get the extra repetition.
    """
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")
    rows = rows.withColumn("draw", drawn).withColumn("bucket", F.pmod("draw", F.lit(BUCKETS)))
    key = ["source", "bucket"]
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*key)
        .agg(F.sum("size").alias("bucket_size"))
        .withColumn("start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
        .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "start")
    )
    inside = Window.partitionBy(*key).orderBy("draw", "doc_id", "size")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("upto", running)
    rows = rows.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    goals = goals.select(
        F.col("source").alias("g"), F.col("size").alias("source_size"), "target"
    )
    rows = rows.join(goals, F.col("source").eqNullSafe(F.col("g")))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    middle = F.col("start") + F.col("upto") - F.col("size") / 2
    rest = F.col("target") - F.floor("epochs") * F.col("source_size")
    return rows.withColumn("epochs", epochs).withColumn(
        "copies", (F.floor("epochs") + (middle < rest).cast("long")).cast("long")
    )


def mix(docs, weights, max_epochs=3.0, total=None, seed=17, id_col="doc_id", text_col="text",
        source_col="source"):
    """Rows with their size, their source's size and target, and `copies`: how often the mix has them.

    `weights` has the columns source and weight. Each source's words in the mix differ from its target
    by at most half of one row. `h1` and `h2` are the `row_hashes` of id, source and text.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        *row_hashes(id_col, source_col, text_col),
    )
    sums = rows.groupBy("source").agg(F.sum("size").alias("size"))
    given = weights.select(F.col("source").alias("w"), "weight")
    sums = saved(
        sums.join(given, F.col("source").eqNullSafe(F.col("w")), "left").select(
            "source", "size", "weight"
        )
    )
    return _copies(rows, targets(sums, max_epochs, total), seed)


def mixed(docs, weights, id_col="doc_id", text_col="text", source_col="source", **options):
    """The rows of the mix: those of `docs`, each as often as the mix has it.

    Rows that repeat id, source and text are copies of the first of them that Spark meets.
    """
    drawn = mix(docs, weights, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    drawn = drawn.groupBy("h1", "h2").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    rows = docs.select(F.struct("*").alias("row"), *row_hashes(id_col, source_col, text_col))
    rows = rows.groupBy("h1", "h2").agg(F.first("row").alias("row"))
    taken = rows.join(drawn, ["h1", "h2"])
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def cycled_weights(docs, source_col="source", cycle=(1, 2, 3)):
    """Weights for the sources in order of code points, null last: the cycle's values in turn.

    The order is found over one row per source, so the one task of that window grows with the number of
    sources and not with the rows.
    """
    names = docs.select(F.col(source_col).alias("source")).distinct()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(cycle) + 1
    values = F.array(*(F.lit(float(v)) for v in cycle))
    return names.withColumn("weight", F.element_at(values, place.cast("int")))
