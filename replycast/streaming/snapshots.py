"""Key-value snapshots kept up by a stream: a base and the newest rows of each batch since.

A batch is written once as its newest row of each key, in a folder named by feed and batch; that folder's
success mark is the ledger. Readers put the base and the batches not yet in it together and take the newest
row of each key. The newest is the one with the highest version, of equal ones the largest row, so it does
not matter in which order batches come, or how often: a batch that is run again, or rows sent again in
a later batch, change nothing. A batch costs what it holds, not what the snapshot holds; `compact` writes a
new base now and then.
"""

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.folders import finished


def _latest_per_key(df, key, version):
    rest = [c for c in df.columns if c not in (key, version)]
    newest = F.max(F.struct(version, *rest)).alias("row")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(newest).select(key, "row.*").select(df.columns)


def _base(spark, path):
    """Last finished base and the batches that are in it, as folders' last two names."""
    bases = finished(spark, f"{path}/base/number=*")
    if not bases:
        return None, set()
    last = max(bases, key=lambda p: int(p.rpartition("=")[2]))
    ledger = spark.read.parquet(last.replace("/base/", "/covered/"))
    return last, {row.batch for row in ledger.collect()}  # one row a batch between two compactions


def _name(folder):
    return "/".join(folder.rsplit("/", 2)[1:])


def _together(spark, folders, key, version):
    """Newest row of each key over all folders, which may have their columns in any order."""
    parts = [spark.read.parquet(f) for f in folders]
    return _latest_per_key(reduce(DataFrame.unionByName, parts), key, version)


def read_snapshot(spark, path, key="id", version="version"):
    """The newest row of each key, of all finished batches."""
    base, covered = _base(spark, path)
    batches = [f for f in finished(spark, f"{path}/batches/feed=*/batch=*") if _name(f) not in covered]
    folders = [*([base] if base else []), *batches]
    if not folders:
        raise ValueError(f"no snapshot at {path}")
    return _together(spark, folders, key, version)


def apply_batch(updates, path, feed, batch_id, key="id", version="version"):
    """Add a batch to the snapshot, unless the ledger has it; whether it was added.

    Rows without a key are left out. A write that broke off has no mark and is written over.
    """
    spark = updates.sparkSession
    if not re.fullmatch(r"[\w.-]+", feed):
        raise ValueError("a feed's name has letters, digits, dots, dashes and underscores")
    place = f"batches/feed={feed}/batch={batch_id}"
    if finished(spark, f"{path}/{place}"):
        return False
    _latest_per_key(updates, key, version).write.mode("overwrite").parquet(f"{path}/{place}")
    return True


def compact(spark, path, key="id", version="version"):
    """Write all finished batches into a new base. Batches that finish meanwhile stay beside it.

    The ledger of what a base covers is written before the base, whose own mark puts both in force.
    Old folders are left to the owner, as readers may have them open.
    """
    base, covered = _base(spark, path)
    batches = [f for f in finished(spark, f"{path}/batches/feed=*/batch=*") if _name(f) not in covered]
    if not batches:
        return
    number = 1 + (int(base.rpartition("=")[2]) if base else 0)
    names = [(name,) for name in [*covered, *map(_name, batches)]]
    ledger = spark.createDataFrame(names, "batch string").coalesce(1)
    ledger.write.mode("overwrite").parquet(f"{path}/covered/number={number}")
    rows = _together(spark, [*([base] if base else []), *batches], key, version)
    rows.write.mode("overwrite").parquet(f"{path}/base/number={number}")


def upsert_stream(updates, path, feed, checkpoint, key="id", version="version", every=None, trigger=None):
    """Keep the snapshot at `path` up with a stream of rows; `every` so many batches it is compacted.

    `feed` names the stream and its checkpoint together: a stream begun anew, whose batches are numbered
    from 0 again, needs a name of its own, or the ledger takes its batches for the old ones.
    """

    def write(batch, batch_id):
        apply_batch(batch, path, feed, batch_id, key, version)
        if every and batch_id % every == every - 1:
            compact(batch.sparkSession, path, key, version)

    return (
        updates.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
