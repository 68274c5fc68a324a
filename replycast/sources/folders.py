"""Folders that a job has written."""


def matching(spark, pattern):
    """Paths, in order, that match a pattern."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in fs.globStatus(place) or [])


def finished(spark, pattern):
    """Paths, in order, of the folders that match `pattern` and have a success mark."""
    return [mark.rpartition("/")[0] for mark in matching(spark, f"{pattern}/_SUCCESS")]
