"""Which dump files still have to be imported."""

from pyspark.sql import functions as F


def pending_files(requested, existing, overwrite=False):
    """Requested files (`file_name`, `size`) that are not there yet; all with `overwrite`."""
    if overwrite:
        return requested
    return requested.join(existing.select("file_name").distinct(), "file_name", "left_anti")


def pending_size(pending):
    """Number of files and their total size in bytes."""
    return pending.agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size")
    )
