"""Stored tables: laid out for joins, changed partition by partition, replaced in one step.

Parquet folders partitioned by columns, and catalog tables that are bucketed too. A change writes only the partitions it
touches, with dynamic partition overwrite; a reload writes a new folder and then points the table at it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.dml import upsert
from shelfwise.operators.listing import dedupe_first
from shelfwise.session import cut_lineage, shared_dir


def save_laid_out(df: DataFrame, table: str, path: str, partition_by: list[str], bucket_by: str, buckets: int) -> None:
    """A catalog table partitioned by columns and bucketed by a key.

    Tables with the same buckets join on the key without a shuffle, and a join with few partition values prunes the scan at run
    time. Rows are dealt by the key first, so there is one file per bucket and partition, not one per task as well.
    """
    dealt = df.repartition(buckets, bucket_by).sortWithinPartitions(*partition_by, bucket_by)
    writer = dealt.write.format("parquet").option("path", path).mode("overwrite").partitionBy(*partition_by)
    writer.bucketBy(buckets, bucket_by).sortBy(bucket_by).saveAsTable(table)


def join_in_place(left: DataFrame, right: DataFrame, bucket: str, also: list[str], how: str = "left") -> DataFrame:
    """Join two tables with the same buckets on their key and on further columns, without a shuffle.

    Only the bucketed key may count as a join key, or Spark would deal both sides out by all of them; equality of the further
    columns is tested within the key's rows, as two bounds. The right side's copies of those columns go.
    """
    other = right.withColumnsRenamed({c: f"_of_{c}" for c in [bucket, *also]})
    match = F.col(bucket) == F.col(f"_of_{bucket}")
    for c in also:
        match &= (F.col(c) >= F.col(f"_of_{c}")) & (F.col(c) <= F.col(f"_of_{c}"))
    return left.join(other, match, how).drop(*[f"_of_{c}" for c in [bucket, *also]])


def touched(stored: DataFrame, incoming: DataFrame, partition_by: list[str]) -> DataFrame:
    """Stored rows of the partitions that occur in ``incoming``; NULL is a partition too.

    The list of partitions becomes a filter on the partition columns, so the scan lists and reads no others. It is at most
    as long as the table's own list of partitions, which the driver holds for every scan of it.
    """
    key = F.to_json(F.struct(*partition_by), {"ignoreNullFields": "false"})
    known = stored.select(key.alias("_p")).distinct()
    wanted = incoming.select(key.alias("_p")).distinct().join(known, "_p", "left_semi")
    return stored.where(key.isin([r["_p"] for r in wanted.collect()]))


def rewrite(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite the partitions that occur in ``df`` and no others; it may read the same table, so it is staged first."""
    staged = cut_lineage(df, "partitions")
    sizes = staged.repartition(*partition_by) if partition_by else staged
    sizes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def upsert_partitioned(
    spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], cols: list[str], order: list[Column | str], partition_by: list[str],
) -> None:
    """``upsert`` into a stored table of which only the partitions that occur in ``incoming`` are read and written.

    The partition columns must be part of the key, so that a row's partition never changes. Files of other
    partitions stay as they are. Rows whose key has a NULL are inserted, as in ``upsert``.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    stored = spark.read.parquet(path)
    # Read twice: for its partitions and for its rows.
    incoming = cut_lineage(incoming.select(stored.columns), "incoming")
    rewrite(upsert(incoming, touched(stored, incoming, partition_by), keys, cols, order), path, partition_by)


def change_partitions(spark: SparkSession, path: str, where: Column, change: Callable[[DataFrame], DataFrame], partition_by: list[str]) -> None:
    """Replace the rows of the partitions that ``where`` (a condition on partition columns) chooses by ``change`` of them.

    ``change`` must keep rows in their partitions. The condition reaches the scan, so other partitions are neither read nor written.
    """
    stored = spark.read.parquet(path)
    rewrite(change(stored.where(where)).select(stored.columns), path, partition_by)


def location(spark: SparkSession, table: str) -> str:
    """Folder that a catalog table reads."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


def swap_table(df: DataFrame, table: str, purpose: str = "reload") -> str | None:
    """Replace a catalog table's rows in one step; returns the folder that it read before (None: the table is new).

    The rows are written to a new folder first; then the table's location is set to it. Readers see the old rows or the new ones, never
    none and never both, and a job that fails while writing changes nothing. ``df`` may read the table itself. The old folder stays
    for queries that are still reading it; the caller removes it later.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    if not spark.catalog.tableExists(table):
        df.write.format("parquet").option("path", path).saveAsTable(table)
        return None
    stored = spark.table(table)
    if df.schema.simpleString() != stored.schema.simpleString():
        raise ValueError(f"{table} has other columns: {stored.schema.simpleString()}")
    before = location(spark, table)
    df.write.parquet(path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return before


def sink_numbered(stream: DataFrame, path: str, checkpoint: str, name: str, every: str | None = None):
    """Save each micro-batch as the partition of its own number: a repeated one overwrites what it wrote before.

    Nothing of the table is read while saving, however large it is; keys are settled when it is read (``settled``). ``name`` tells
    the streams that write to one table apart (an interim and a final save, say).
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    save = lambda batch, number: save_number(batch, path, name, number)
    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def save_number(batch: DataFrame, path: str, name: str, number: int) -> None:
    """Write one micro-batch in place of an earlier try of it."""
    rows = batch.withColumn("_stream", F.lit(name)).withColumn("_batch", F.lit(number).cast("bigint"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_stream", "_batch").parquet(path)


def settled(table: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key over all micro-batches, NULL being a key value like any other."""
    return dedupe_first(table, keys, [*order, "_stream", "_batch"]).drop("_stream", "_batch")
