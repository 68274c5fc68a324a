"""Key-value snapshots: one row per key, replaced by newer rows of the same key."""

from pyspark.sql import functions as F

BUCKETS = 256
#: Keys up to which a look-up names them in the scan; Parquet takes so many apart from each other.
FEW = 10


def latest_per_key(df, key, version=None):
    """One row per key: the one with the highest version, of equal ones the largest row.

    The maximum is taken before the shuffle as well, so many rows of one key do not meet. Without
    `version` rows have no order in time, and the largest row of a key stays.
    """
    rest = [c for c in df.columns if c not in (key, version)]
    order = [version] if version else []
    newest = F.max(F.struct(*order, *rest)).alias("row")
    return df.groupBy(key).agg(newest).select(key, *[f"row.{c}" for c in rest])


def merge_snapshot(current, updates, key="id", version=None):
    """Rows of `current` with those of `updates` put in place or added; the update wins.

    Of rows of `updates` that repeat a key one stays, see `latest_per_key`.
    """
    newest = latest_per_key(updates, key, version)
    kept = current.join(newest.select(key), key, "left_anti")
    return kept.unionByName(newest.select(current.columns))


def _versions(spark, path, begun=False):
    """Finished versions of a snapshot, as numbers in order; with `begun`, unfinished ones too."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/version=*" + ("" if begun else "/_SUCCESS"))
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    places = [status.getPath() for status in fs.globStatus(pattern)]
    names = [(place if begun else place.getParent()).getName() for place in places]
    return sorted(int(name.partition("=")[2]) for name in names)


def read_snapshot(spark, path):
    """Last finished version of a snapshot."""
    return spark.read.parquet(f"{path}/version={_versions(spark, path)[-1]}")


def _bucket(key):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int")


def publish_indexed(rows, path, key="id"):
    """Write `rows`, one for each key, as a new version that `read_matching` finds its way in.

    Rows are dealt into buckets by key, sorted by it, and files have a Bloom filter of it, as large as
    the file's keys ask for.
    """
    number = max([0, *_versions(rows.sparkSession, path, begun=True)]) + 1
    dealt = rows.withColumn("bucket", _bucket(key)).repartition("bucket").sortWithinPartitions("bucket", key)
    writer = dealt.write.mode("errorifexists").option(f"parquet.bloom.filter.enabled#{key}", "true")
    # without this a filter has a megabyte, however few keys there are
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.partitionBy("bucket").parquet(f"{path}/version={number}")


def read_matching(spark, path, keys, key="id"):
    """Rows of the last version that may have one of `keys`, a table with a column `key`.

    Files of buckets without a key are not opened. If there are few keys, they go down to the scan, where
    each file's bounds and Bloom filter keep out the row groups without them.
    """
    asked = keys.select(key).where(F.col(key).isNotNull())
    # at most BUCKETS numbers, and one key more than can go down
    buckets = asked.agg(F.collect_set(_bucket(key))).first()[0]
    few = [row[0] for row in asked.distinct().limit(FEW + 1).collect()]
    rows = read_snapshot(spark, path).where(F.col("bucket").isin(buckets))
    return (rows.where(F.col(key).isin(few)) if len(few) <= FEW else rows).drop("bucket")


def upsert_snapshot(updates, path, key="id", version=None):
    """Write `updates` over the snapshot at `path`, as a new version beside the old ones.

    Readers keep the version they opened, and a failed write leaves the last one in force. A number
    that another writer has begun is never written to: the later one of two fails.
    """
    spark = updates.sparkSession
    done = _versions(spark, path)
    if done:
        rows = merge_snapshot(read_snapshot(spark, path), updates, key, version)
    else:
        rows = latest_per_key(updates, key, version)
    number = max([0, *_versions(spark, path, begun=True)]) + 1
    rows.write.mode("errorifexists").parquet(f"{path}/version={number}")
    return read_snapshot(spark, path)
