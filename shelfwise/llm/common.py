"""What the operators share: staging, word counts, global ranks, text tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import shared_dir

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Buckets up to which each task of a scan writes a file into each.
FEW_BUCKETS = 64

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a query of this subpackage and, where one exists, the SQL text with the same rows."""

    def register(plan: Plan) -> Plan:
        QUERIES[name] = plan
        if sql is not None:
            CHECKS[name] = sql
        return plan

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: work is done once, a lost executor costs a re-read."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_table(df: DataFrame, key: str, purpose: str) -> DataFrame:
    """Stage rows with texts bucketed by ``key``: later joins on it move the other side only.

    Written straight from the scan, each task adds a file to each bucket; above ``FEW_BUCKETS`` buckets the
    rows are shuffled first, which keeps the number of files at the number of buckets.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if buckets > FEW_BUCKETS:
        df = df.repartition(buckets, key)
    name = f"llm_{purpose}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", shared_dir(spark, purpose)).option("compression", "zstd")
    writer.bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(*columns: Column) -> Column:
    """64-bit key of a row's columns, nulls included."""
    parts = [c for x in columns for c in (x.isNull(), x)]
    return F.xxhash64(*parts)


def ranked(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (), name: str = "_rank", purpose: str = "rank") -> DataFrame:
    """Number the rows from 0 in each group, in ``order``, with no window over a whole group.

    Rows are range-partitioned by group and order and staged with their place; a group's start in
    a partition and its rows in earlier partitions (one row per group and partition) give the rank.
    Group columns must not be null; column names starting with ``_pl`` are taken.
    """
    by = [*map(F.col, group), *(F.col(c) if isinstance(c, str) else c for c in order)]
    placed = stage(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_pl_at", F.monotonically_increasing_id()), purpose)
    placed = placed.withColumn("_pl_part", F.shiftrightunsigned("_pl_at", 33))
    starts = placed.groupBy(*group, "_pl_part").agg(F.min("_pl_at").alias("_pl_first"), F.count("*").alias("_pl_n"))
    earlier = Window.partitionBy(*group).orderBy("_pl_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_pl_before", F.coalesce(F.sum("_pl_n").over(earlier), F.lit(0)))
    out = placed.join(starts, [*group, "_pl_part"])
    rank = F.col("_pl_at") - F.col("_pl_first") + F.col("_pl_before")
    return out.withColumn(name, rank).drop("_pl_at", "_pl_part", "_pl_first", "_pl_n", "_pl_before")
