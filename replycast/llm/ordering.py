"""Places in a global order, found without one task that holds the order or a group of it."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import saved


def placed(rows, order, group=(), size=None, name="before"):
    """`rows` with `name`: how many rows of the same group stand before a row in `order`, or the sum of
    their `size`.

    `order` are columns, best with no ties; `group` are names of columns without nulls. Rows are dealt by
    ranges of group and order and kept like that in the shared folder, so a hot group is spread over
    many tasks and a task run again meets the same ranges. Running sums go over the rows of a range; the
    ranges' own sums are one row for each range and group, and a window runs over those alone. `rows` are
    computed twice, once for the bounds of the ranges. An empty table stays empty.
    """
    keys = [F.col(g) for g in group] + [F.col(o) if isinstance(o, str) else o for o in order]
    ranges = saved(rows.repartitionByRange(*keys).sortWithinPartitions(*keys))
    ranges = ranges.withColumns(
        {
            "_range": F.spark_partition_id(),
            "_place": F.monotonically_increasing_id(),
            "_size": F.col(size).cast("long") if size else F.lit(1).cast("long"),
        }
    )
    upto = Window.unboundedPreceding, -1
    here = Window.partitionBy("_range", *group).orderBy("_place").rowsBetween(*upto)
    ranges_before = Window.partitionBy(*group).orderBy("_range").rowsBetween(*upto)
    starts = ranges.groupBy("_range", *group).agg(F.sum("_size").alias("_sum"))
    starts = starts.withColumn("_start", F.coalesce(F.sum("_sum").over(ranges_before), F.lit(0)))
    inside = ranges.withColumn("_inside", F.coalesce(F.sum("_size").over(here), F.lit(0)))
    joined = inside.join(starts.drop("_sum"), ["_range", *group])
    return joined.select(*rows.columns, (F.col("_start") + F.col("_inside")).alias(name))
