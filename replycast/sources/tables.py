"""Catalog tables."""


def read_table(spark, database, table):
    return spark.table(f"{database}.{table}")


def save_table(df, name, partition_keys=None, path=None):
    """Replace a Parquet table, external if `path` is given.

    A managed table is written under another name first and takes the old one's place when it is
    whole, so a failed job leaves the old table, and a table may be computed from itself. An external
    table is written in place.

    Rows are rebalanced, by the partition columns if there are any: a small table ends up in one
    file and a large partition in several of the advised size.
    """
    keys = list(partition_keys or [])
    spark, target = df.sparkSession, name if path else f"{name}_next"
    spark.sql(f"drop table if exists {target}")
    writer = df.hint("rebalance", *keys).write.mode("overwrite").format("parquet")
    if keys:
        writer = writer.partitionBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(target)
    if target != name:
        spark.sql(f"drop table if exists {name}")
        spark.sql(f"alter table {target} rename to {name}")
