"""Session settings and the shared scratch folder."""

import tempfile
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Spark's setting for shuffle files that go when their query ends; a query that runs again makes them anew.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app="replycast", master=None, conf=None):
    """Session with the settings the library expects; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """Folder all executors can read: `spark.checkpoint.dir`, or a temporary one in local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="replycast-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextmanager
def shuffles_freed(spark):
    """Queries built meanwhile remove their shuffle files when they end, not when the driver collects garbage."""
    before = spark.conf.get(FREED)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def written(df, name):
    """`df` written below the shared folder and read again; the shuffle files of making it are gone by then."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
