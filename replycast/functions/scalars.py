"""Small column helpers: dates, keys, defaults, shares."""

from pyspark.sql import functions as F


def date_parts(df, ts, prefix="post"):
    """Add hour, day of week (1 = Sunday), month and year of a timestamp column."""
    at = F.col(ts)
    return df.withColumns(
        {
            f"{prefix}_hour": F.hour(at),
            f"{prefix}_dayofweek": F.dayofweek(at),
            f"{prefix}_month": F.month(at),
            f"{prefix}_year": F.year(at),
        }
    )


def within_days(start, event, n):
    """True if `event` falls fewer than `n` calendar days after `start`; earlier events count."""
    return F.datediff(event, start) < n


def age_days(start, asof):
    return F.datediff(asof, start)


def n_tags(tags):
    return F.coalesce(F.size(tags), F.lit(0))


def presence_flag(col):
    return col.isNotNull().cast("int")


def with_defaults(df, defaults):
    """Replace nulls column by column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def composite_key(dataset, key):
    return F.concat(dataset, F.lit(":"), key.cast("string"))


def share(count, total):
    """`count / total`, 0 where the total is 0 or missing."""
    return F.coalesce(F.try_divide(count, total), F.lit(0.0))


def pos_share(count, words):
    return share(count, words)


def title_in_body(title_stems, body_stems):
    """Share of distinct title stems that also occur in the body; null without title stems."""
    both = F.size(F.array_intersect(title_stems, body_stems))
    return F.try_divide(both, F.size(F.array_distinct(title_stems)))


def split_tags(col):
    """`"<a><b-c>"` to `["a", "b-c"]`."""
    opened = F.replace(col, F.lit("<"), F.lit(""))
    return F.split(F.rtrim(F.replace(opened, F.lit(">"), F.lit(" "))), " ")


def forum_key(col):
    """Forum address to dataset name: lower case, dots to dashes."""
    return F.translate(F.lower(col), ".", "-")


def forum_flag_name(dataset_name):
    return dataset_name.replace("-", "_") + "_flag"
