"""Import of dump files that were not imported before."""

from .dump import read_entity


def import_new(spark, entity, source, target, checkpoint, files_per_batch=None):
    """Import the files below `source` that no earlier run imported into the Parquet table at `target`.

    The files are a stream that ends when all that are there have been read; its checkpoint is the ledger, so a
    second run reads new files alone, and one that broke off goes on with the batch that it was at. A file is
    a forum's, and the table is partitioned by forum: a batch replaces the partitions of its own files, each
    of them moved into place when the whole batch is written, so a failed one leaves the old partitions as
    they were, and one that is run again changes nothing. A new edition of a forum's file is imported if it has
    another path, such as a folder for each delivery. Returns the stream that was started.
    """
    rows = read_entity(spark, entity, source, files_per_batch=files_per_batch or 0)

    def write(batch, batch_id):
        writer = batch.hint("rebalance", "dataset_name").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("dataset_name").parquet(target)

    stream = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()
