"""Importance resampling to a target distribution: hashed n-grams, Gumbel noise, the best scores.

Words are runs of ASCII letters and digits, lower-cased, and of any other characters beyond ASCII. A
text's features are its runs of 1 to `order` words. The gain of a bucket of features is the logarithm of
its share in the target over its share in the documents, a document's weight the mean gain of its
features, its score that plus seeded Gumbel noise; the highest scores are drawn without replacement.

A null or empty text has no features, weight 0, and is never drawn; very long texts count whole. A null
id is noised like an empty one and comes last among ties. Repeated rows are documents of their own, with
equal scores. Without documents the result is empty, without targets all words are equally rare there.
Other columns of both tables may have any names.

Texts are read twice, for the corpus counts and for the weights. Each Arrow batch is lower-cased, split and
dictionary-encoded, so a word is hashed once a batch and a longer run goes on from the hash of the run
without its last word. Only one row for each document is shuffled.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import saved, slices, travels

travels(__name__)

#: What stands between words, after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
ORDER = 2
MIN_WORDS = 20
SEED = 7


def _words(texts):
    """Codes of a batch's words, the text of each, and the distinct words as bytes."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts)
    words = pc.not_equal(flat, "")
    coded = pc.dictionary_encode(flat.filter(words))
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    return coded.indices.to_numpy().astype(np.int64), parent.filter(words).to_numpy(), distinct


def feature_buckets(texts, order=ORDER, buckets=BUCKETS):
    """For run lengths 1 to `order`: the bucket of each feature of a batch, and the text it stands in."""
    codes, parent, words = _words(texts)
    crcs = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words))
    yield crcs[codes] % buckets, parent
    runs = codes
    for n in range(2, order + 1):
        # a run is the shorter run that begins it and the word that stands n - 1 places on
        same = parent[n - 1 :] == parent[: len(parent) - n + 1]
        pairs = (runs[: len(same)] * max(len(words), 1) + codes[n - 1 :])
        coded = pc.dictionary_encode(pa.array(pairs))
        distinct = coded.dictionary.to_numpy()
        begun, last = distinct // max(len(words), 1), distinct % max(len(words), 1)
        crcs = np.fromiter(
            (zlib.crc32(b" " + words[w], c) for c, w in zip(crcs[begun].tolist(), last.tolist())),
            np.int64,
            len(distinct),
        )
        runs = coded.indices.to_numpy().astype(np.int64)
        yield (crcs[runs] % buckets)[same], parent[n - 1 :][same]


def bucket_counts(docs, text_col="text", order=ORDER, buckets=BUCKETS):
    """Features of all texts per bucket: an array, added up in each task and then over the tasks."""

    def count(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                for found, _ in feature_buckets(part.column(0), order, buckets):
                    sums += np.bincount(found, minlength=buckets)
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[there])], names=["bucket", "n"])

    per_task = docs.select(text_col).mapInArrow(count, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for bucket, n in per_task.groupBy("bucket").agg(F.sum("n")).collect():  # at most one row a bucket
        counts[bucket] = n
    return counts


def gains(corpus, target):
    """Thousand times the logarithm of a bucket's smoothed share in the target over that in the corpus."""
    all_corpus, all_target, buckets = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_corpus + buckets) / ((s + 1) * (all_target + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weights(docs, gain, id_col="doc_id", text_col="text", order=ORDER):
    """`doc_id`, `n_words`, `n_features` and `weight`, the floored mean of the gains of its features."""

    def weigh(batches):
        for batch in batches:
            for part in slices(batch):
                rows = part.num_rows
                total, n, n_words = (np.zeros(rows, np.int64) for _ in range(3))
                for length, (found, parent) in enumerate(feature_buckets(part.column(1), order, len(gain)), 1):
                    if not len(parent):
                        break
                    # parents ascend, so a text's features are one segment
                    texts, starts, sizes = np.unique(parent, return_index=True, return_counts=True)
                    total[texts] += np.add.reduceat(np.take(gain, found), starts)
                    n[texts] += sizes
                    if length == 1:
                        n_words = n.copy()
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), *map(pa.array, (n_words, n, weight))],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    schema = "doc_id long, n_words long, n_features long, weight long"
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(weigh, schema)


def _noise(seed):
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resample(docs, target, percent=25, min_words=MIN_WORDS, order=ORDER, buckets=BUCKETS, seed=SEED,
             id_col="doc_id", text_col="text", target_col="text"):
    """Every document's `n_features`, `weight`, `score` and, of the drawn ones, `rank`.

    Of the documents with `min_words` words, `percent` hundredths are drawn. A rank is the number of
    higher scores, from the counts of each score, and the place among equal ones. Scores are whole
    thousandths and their noise is continuous, so a score is held by at most 1 in 2,700 of the documents
    as long as ids differ, and the table of scores has some tens of thousands of rows at any size.
    """
    corpus = bucket_counts(docs, text_col, order, buckets)
    wanted = bucket_counts(target, target_col, order, buckets)
    weighed = weights(docs, gains(corpus, wanted), id_col, text_col, order)
    scored = saved(weighed.withColumn("score", F.col("weight") + _noise(seed)))

    enough = F.col("n_words") >= min_words
    held = saved(scored.filter(enough).groupBy("score").agg(F.count("*").alias("n")))
    n_drawn = (held.agg(F.sum("n")).first()[0] or 0) * percent // 100
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("score", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("higher"))
    held = held.filter(F.col("higher") < n_drawn)
    # scores are not null, so the rows without one in `held` are those beyond the last rank
    joined = scored.join(held, "score", "left")
    near = F.coalesce(enough & F.col("higher").isNotNull(), F.lit(False))
    among = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    ranked = joined.filter(near).withColumn("rank", F.col("higher") + F.row_number().over(among))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    others = joined.filter(~near).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(columns).unionByName(others.select(columns))


def drawn_rows(docs, drawn, id_col="doc_id"):
    """The rows of `docs` that were drawn; ids must be distinct."""
    taken = drawn.filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias(id_col))
    return docs.join(taken, id_col, "left_semi")
