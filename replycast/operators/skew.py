"""Running totals that stay spread out when one key holds much of the data."""

from functools import reduce
from operator import or_

from pyspark.sql import Window
from pyspark.sql import functions as F


def running_totals(events, keys, at, sums, inclusive=False, lags=None, first=None, wanted=None):
    """Add, to each event, totals over the earlier events of its key.

    events     rows with key columns and a timestamp column `at`
    sums       {output: numeric column}, summed over events before `at` (up to and including `at`
               with `inclusive`); 0 if there is none
    lags       {output: (column, days)}, summed over events at least that many calendar days older
    first      output column for the earliest `at` of the key up to this event
    wanted     which events to return with their totals; the others are only added up

    Events are added up per key and hour, with partial sums before the shuffle. One running total goes
    over the hours of a key, another one over the events of an hour, so the rows of a key are never in
    one window; what a task holds is bounded by a key's hours or an hour's events. Hours without a wanted
    event are left out of the second one. The columns of `sums` are computed where they are added up, so
    a shuffle carries what they are made of. An event without a time has no earlier ones.
    """
    dated = F.col(at).isNotNull()
    lags = lags or {}
    parts = {**sums, **{out: column for out, (column, _) in lags.items()}}
    hour = F.unix_date(F.to_date(at)) * 24 + F.hour(at)
    asked = F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))
    timed = events.withColumns({"_hour": hour, "_asked": asked})

    by_hour = Window.partitionBy(*keys).orderBy("_hour")
    by_day = Window.partitionBy(*keys).orderBy(F.floor(F.col("_hour") / 24))
    carried = {out: by_hour.rowsBetween(Window.unboundedPreceding, -1) for out in sums}
    for out, (_, days) in lags.items():
        carried[out] = by_day.rangeBetween(Window.unboundedPreceding, -days)
    hours = timed.where(dated).groupBy(*keys, "_hour").agg(
        *[F.sum(column).alias(out) for out, column in parts.items()],
        F.min(at).alias("_from"),
        F.max("_asked").alias("_wanted"),
    )
    carry = hours.select(
        *keys,
        "_hour",
        *[F.sum(out).over(window).alias(f"_before_{out}") for out, window in carried.items()],
        F.min("_from").over(by_hour.rowsBetween(Window.unboundedPreceding, 0)).alias("_first"),
        "_wanted",
    ).where("_wanted")

    in_hour = Window.partitionBy(*keys, "_hour").orderBy(F.unix_micros(at))
    before = in_hour.rangeBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    none = F.lit(0)
    totals = {
        out: F.coalesce(f"_before_{out}", none) + F.coalesce(F.sum(F.when(dated, column)).over(before), none)
        for out, column in sums.items()
    }
    totals |= {out: F.coalesce(f"_before_{out}", none) for out in lags}
    if first:
        totals[first] = F.col("_first")
    kept = [F.col(c) for c in events.columns if c not in totals]
    # a key with a null finds no hours, but its events of an hour do count
    unkeyed = reduce(or_, [F.col(key).isNull() for key in keys])
    near = timed.join(carry, [*keys, "_hour"], "left").where(F.col("_asked") | F.col("_wanted") | unkeyed)
    counted = near.select(*kept, *[total.alias(out) for out, total in totals.items()], "_asked")
    return counted.where("_asked").drop("_asked")
