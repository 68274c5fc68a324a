"""Forum list and one-hot flags."""

from pyspark.sql import functions as F

from ..functions.scalars import forum_flag_name

def forum_names(df):
    """Distinct dataset names in order, as a DataFrame."""
    return df.select("dataset_name").distinct().orderBy("dataset_name")


def forum_list(df, most=5_000):
    """Distinct dataset names in order; they become column names.

    The driver holds the list, so more than `most` of them are refused; raise it to allow more.
    """
    rows = forum_names(df).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} forums")
    return [row.dataset_name for row in rows]


def forum_flags(df, forums=None):
    """Add one 0/1 column per forum: those given, or all that occur."""
    forums = forum_list(df) if forums is None else forums
    name = F.col("dataset_name")
    return df.withColumns(
        {forum_flag_name(f): F.when(name == f, 1).otherwise(0) for f in forums}
    )
