"""Periodic collection, keyed saving, duplicate skipping and failure counts as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import shared_dir
from shelfwise.sources.sinks import append_new

def ingest_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New files of a table (a folder, or one file) as a stream; ``max_files`` bounds a micro-batch.

    A plain path must be a folder; the same path as a pattern may also be a file.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def run(stream: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """Start an append to a Parquet table: once over what is there, or again ``every`` interval."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**trigger).start()
    )


def sink_batches(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str],
    partition_by: list[str] | None = None, every: str | None = None,
):
    """Save each micro-batch by key.

    Interim and final saves, and a micro-batch repeated after a failure, store a row once.
    """

    def save(batch: DataFrame, _: int) -> None:
        append_new(batch, path, keys, order, partition_by)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def dedupe_stream(stream: DataFrame, keys: list[str], at: str, delay: str = "2 days") -> DataFrame:
    """Each key once while it is within ``delay`` of its first appearance.

    One step with one state row per key, so that a key is let through again exactly when its state is
    gone; state is dropped once the watermark has passed. Rows later than ``delay`` are dropped by Spark
    and counted in the query's progress (``numRowsDroppedByWatermark``).
    """
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def failure_stream(
    stream: DataFrame, at: str = "crawl_datetime", value: str = "retailprice", delay: str = "1 hour",
    window: str = "24 hours", slide: str = "1 hour",
) -> DataFrame:
    """Failures per URL in sliding windows; partial counts are combined before the shuffle."""
    failed = stream.where(F.col(value).isNull()).withWatermark(at, delay)
    counts = failed.groupBy(F.window(at, window, slide), "url").agg(F.count(F.lit(1)).alias("fail_count"))
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "url", "fail_count"
    )


def failure_panes(
    stream: DataFrame, by: tuple[str, ...] = ("url",), at: str = "crawl_datetime", value: str = "retailprice", delay: str = "1 hour", pane: str = "1 hour",
) -> DataFrame:
    """Failures per group and pane of time, for sums over the last panes when they are read (``failures_since``).

    A row updates one state row, that of its pane, where sliding windows update one for each window around it (24 for a day
    that slides by the hour). Write it with ``log_updates``, which also gives the pane that is still open.
    """
    failed = stream.where(F.col(value).isNull()).withWatermark(at, delay)
    counts = failed.groupBy(F.window(at, pane), *by).agg(F.count(F.lit(1)).alias("fail_count"))
    return counts.select(F.col("window.start").alias("pane_start"), F.col("window.end").alias("pane_end"), *by, "fail_count")


def failures_since(updates: DataFrame, now: Column, hours: int = 24, by: tuple[str, ...] = ("url",)) -> DataFrame:
    """Failures per group in the ``hours`` before ``now``, from logged panes; panes that the period cuts count whole where they end in it.

    Exact where ``now`` is the end of a pane. A pane's newest count is its last one.
    """
    panes = newest_counts(updates, [*by, "pane_start", "pane_end"], "fail_count")
    since = now - F.make_interval(hours=F.lit(hours))
    inside = panes.where((F.col("pane_end") > since) & (F.col("pane_start") < now))
    return inside.groupBy(*by).agg(F.sum("fail_count").alias("fail_count"))


def new_only_stream(stream: DataFrame, stored: DataFrame, keys: list[str], at: str, row: list[str], delay: str = "2 days") -> DataFrame:
    """Rows of a stream whose key is not stored yet, each key once.

    Keys that repeat within the stream are skipped by their state while they are within ``delay`` of their first appearance (one state
    row a key), keys of the stored table by a stream-static anti join, which drops them before any state is kept. A key with a
    NULL in it equals no other: such rows are all new, told apart by ``row`` columns. The stored table is read as it is when the query
    starts; a query that runs for longer than ``delay`` has to be started again to see what others stored meanwhile.
    """
    fresh = stream.join(stored.select(*keys), keys, "left_anti").select(stream.columns)
    own = F.when(F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x), F.to_json(F.struct(*row)))
    return dedupe_stream(fresh.withColumn("_row", own), [*keys, "_row"], at, delay).drop("_row")


def log_updates(stream: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """Append each micro-batch's changed counts with the batch's number: windows that are still open come out at once."""

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("bigint")).write.mode("append").parquet(path)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(save).outputMode("update").option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def newest_counts(updates: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The last count logged for each key; a micro-batch that was repeated after a failure logged the same."""
    return updates.groupBy(*keys).agg(F.max_by(value, "_batch").alias(value))


def drain(stream: DataFrame, purpose: str) -> DataFrame:
    """Run a stream over everything available and return the table it wrote."""
    spark = stream.sparkSession
    path, checkpoint = shared_dir(spark, purpose), shared_dir(spark, f"{purpose}-state")
    query = run(stream, path, checkpoint)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
