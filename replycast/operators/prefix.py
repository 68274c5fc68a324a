"""Running totals kept up part by part, so that a new dump month does not need all earlier events.

What is kept of a part are its events added up per key and calendar day, under the time of the first of them:
events again, but few. The totals of a new part's events are running totals over the kept ones of the same
keys and the new ones. Parts come in order of time: each has a day on which it begins, and all kept
events lie before that.

A part is a folder of its own below the history's path, named by its first day and dealt into buckets by key.
Adding one writes its own days alone and reads, of earlier parts, the buckets of its keys. A part that is
added again replaces itself and does not count its own former days.
"""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.folders import finished, matching
from .skew import running_totals

BUCKETS = 64


def _bucket(keys):
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _kept(events, keys, at, parts, day):
    """Events added up per key and `day`, null for all days that need not be told apart."""
    sums = [F.sum(column).alias(out) for out, column in parts.items()]
    return events.where(F.col(at).isNotNull()).groupBy(*keys, day.alias("_day")).agg(F.min(at).alias(at), *sums)


def _read(spark, path, before):
    """Kept events of the parts that begin before a day, one table for each, compacted ones together."""
    folders = [f for f in finished(spark, f"{path}/part=*") if f.rpartition("=")[2] < before]
    bases = [f for f in finished(spark, f"{path}/base=*") if f.rpartition("=")[2] <= before]
    if bases:
        upto = bases[-1].rpartition("=")[2]
        folders = [bases[-1], *[f for f in folders if f.rpartition("=")[2] >= upto]]
    folders = [f for f in folders if matching(spark, f"{f}/bucket=*")]  # a part may have no events
    return [spark.read.parquet(f) for f in folders]


def prefix_totals(path, part, events, keys, at, sums, inclusive=False, lags=None, first=None, wanted=None):
    """`running_totals` of the events of a new part, after those that `path` keeps; the part is kept too.

    `part` is the date on which the part begins. Events before it would change totals that were given
    out already, so they are an error; events without a time are counted nowhere and get totals of 0.
    Sums and lags must be columns that can be added up again.
    """
    if lags and any(days < 1 for _, days in lags.values()):
        raise ValueError("lags must be of a day or more")
    spark, name = events.sparkSession, date.fromisoformat(str(part)).isoformat()
    # at most BUCKETS numbers
    start, buckets = events.agg(F.min(F.to_date(at)), F.collect_set(_bucket(keys))).first()
    if start and start.isoformat() < name:
        raise ValueError(f"events before {name}: rebuild the history from the part that they belong to")
    lags = lags or {}
    measures = {f"_sum_{out}": column for out, column in sums.items()}
    measures |= {f"_lag_{out}": column for out, (column, _) in lags.items()}
    marked = events.withColumns({**measures, "_new": F.lit(True)})

    touched = events.select(*keys).distinct().withColumn("bucket", _bucket(keys))
    for kept in _read(spark, path, name):
        kept = kept.where(F.col("bucket").isin(buckets)).join(touched, ["bucket", *keys], "left_semi").drop("bucket", "_day")
        marked = marked.unionByName(kept.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    totals = running_totals(
        marked,
        keys,
        at,
        {out: F.col(f"_sum_{out}") for out in sums},
        inclusive=inclusive,
        lags={out: (F.col(f"_lag_{out}"), days) for out, (_, days) in lags.items()},
        first=first,
        wanted=F.col("_new") if wanted is None else F.col("_new") & wanted,
    )
    days = _kept(
        events.withColumns(measures), keys, at, {m: F.col(m) for m in measures}, F.to_date(at)
    ).withColumn("bucket", _bucket(keys))
    days.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/part={name}")
    return totals.drop("_new", *measures)


def compact(spark, path, upto, keys, at, longest_lag=0):
    """Put all kept events before the day `upto` into one base, days older than any lag into one row a key.

    Parts added later must begin on `upto` or after it. The old folders are left to the owner.
    """
    name = date.fromisoformat(str(upto)).isoformat()
    kept = _read(spark, path, name)
    if not kept:
        return
    kept = reduce(DataFrame.unionByName, kept)
    recent = F.col("_day") >= F.date_sub(F.lit(name).cast("date"), longest_lag)
    measures = [c for c in kept.columns if c.startswith(("_sum_", "_lag_"))]
    rows = _kept(kept.drop("bucket"), keys, at, {m: F.col(m) for m in measures}, F.when(recent, F.col("_day")))
    rows = rows.withColumn("bucket", _bucket(keys))
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/base={name}")
