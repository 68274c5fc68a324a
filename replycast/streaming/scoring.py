"""Scoring of a request stream."""

from pyspark.sql import functions as F

from ..plans.scoring import parse_requests, score_requests


def first_arrivals(raw, remember):
    """Requests whose id has not arrived within the time `remember`, such as "2 days", by keyed state.

    The time is that of arrival, not one that senders state, so that no request is ever too late to be
    answered; ids older than that leave the state. A request without an id is known by its text.
    """
    key = F.when(F.col("request_id").isNull(), F.col("request"))
    timed = raw.withColumns({"_arrived": F.current_timestamp(), "_text": key})
    kept = timed.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(["request_id", "_text"])
    return kept.drop("_arrived", "_text")


def unanswered(batch, out, batch_id):
    """Requests of a batch whose id has no reply in the folders of earlier batches below `out`.

    Only the ids of replies are read. Later folders and the batch's own are not, so a batch that is run
    again after a failure gets the same replies again. Requests without an id are always kept.
    """
    spark = batch.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(out)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    earlier = [f"{out}/batch={k}" for k in _batches(files, folder) if k < batch_id]
    if not earlier:
        return batch
    answered = spark.read.parquet(*earlier).select("request_id").distinct()
    return batch.join(answered, ["request_id"], "left_anti")


def _batches(files, folder):
    """Numbers of the batch folders; a batch begins when the one before it has been written."""
    if not files.exists(folder):
        return []
    return sorted(
        int(status.getPath().getName().removeprefix("batch="))
        for status in files.listStatus(folder)
        if status.getPath().getName().startswith("batch=")
    )


def score_stream(
    raw, load_snapshots, model, forums, out, checkpoint, lexicon=None, trigger=None, remember=None, once=False
):
    """Score a stream of JSON requests (`request_id`, `request`) into Parquet under `out`.

    Each micro-batch is scored by the batch job, because the mean over a request's tags is an
    aggregate. A batch writes its own folder, so one that is run again replaces its output.
    `load_snapshots()` returns the user and tag snapshots and is called for every batch.

    A request that is sent twice is answered twice, unless `remember` is given: then it is answered once
    within that time, from state. With `once`, the replies below `out` are the ledger as well, so that it is
    answered once for ever; that reads the ids of all earlier replies in every batch.
    """

    def write(batch, batch_id):
        if once:
            text = F.when(F.col("request_id").isNull(), F.col("request"))
            batch = batch.withColumn("_text", text).dropDuplicates(["request_id", "_text"]).drop("_text")
            batch = unanswered(batch, out, batch_id)
        users, tags = load_snapshots()
        scored = score_requests(parse_requests(batch), users, tags, model, forums, lexicon)
        scored.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    asked = first_arrivals(raw, remember) if remember else raw
    return (
        asked.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
