"""Exact dedup: group by a 128-bit content hash, compare bytes, keep one row of each class.

Nulls count as empty texts, and empty texts are equal to each other. A null id sorts after all others.
Rows that repeat id and text are copies like any other; those that repeat the kept id and size are all
marked as kept, as nothing tells them apart. An empty table gives an empty table. Only the id and text
columns are read, so other columns can have any names.
"""

from pyspark.sql import functions as F

from .common import saved, without_blanks

SECOND_SEED = 7


def _hashed(docs, id_col, text_col, normal):
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text).cast("long").alias("size"),
        normal(text).alias("body"),
    )
    return rows.withColumns(
        {"h1": F.xxhash64("body"), "h2": F.xxhash64(F.lit(SECOND_SEED), "body")}
    )


def _first():
    """Order of the rows of a class: longest, then smallest id."""
    return F.struct((-F.col("size")).alias("rank"), F.col("doc_id").isNull().alias("no_id"), "doc_id")


def exact_dedup(docs, id_col="doc_id", text_col="text", normal=without_blanks):
    """One row per document: its class's kept id, class size, whether it stays, SHA-256 of its text.

    Two rows are equal if `normal` of their texts has the same bytes. Classes are aggregated on hash and
    text, so bytes are compared inside a hash group and copies are added up before the shuffle. Texts
    that share a 128-bit hash without being equal form classes of their own.
    """
    rows = _hashed(docs, id_col, text_col, normal)
    classes = rows.groupBy("h1", "h2", "body").agg(
        F.count("*").alias("n"), F.min(_first()).alias("first")
    )
    hashes = saved(
        classes.groupBy("h1", "h2").agg(
            F.count("*").alias("n_texts"), F.min("n").alias("n"), F.min("first").alias("first")
        )
    )
    plain = hashes.filter("n_texts = 1").select("h1", "h2", "n", "first")
    narrow = rows.withColumn("text_sha256", F.sha2("body", 256)).drop("body")
    found = narrow.join(plain, ["h1", "h2"])
    collided = hashes.filter("n_texts > 1").select("h1", "h2")
    if not collided.isEmpty():
        apart = classes.join(collided, ["h1", "h2"], "left_semi")
        members = rows.join(apart, ["h1", "h2", "body"])
        found = found.unionByName(
            members.withColumn("text_sha256", F.sha2("body", 256)).drop("body")
        )
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("size") == -F.col("first.rank"))
    return found.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        stays.alias("kept"),
        "text_sha256",
    )
