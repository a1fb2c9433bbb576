"""Sinks. Each table is written by one job of its own, with Spark's commit protocol; nothing is collected to the driver.

A sink of two tables is two such jobs, and a reload deletes before it writes: neither is one transaction.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.order import same
from shelfwise.operators.listing import dedupe_first
from shelfwise.session import cut_lineage


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append to a Parquet table, optionally partitioned."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_new(df: DataFrame, path: str, keys: list[str], order: list, partition_by: list[str] | None = None) -> None:
    """Keyed append: a row whose key is stored already is skipped, so a repeated save adds nothing.

    NULL is a key value like any other here, else a repeated save would add its rows again.

    Where the table is partitioned by columns of the key, only the partitions that occur in ``df``
    are read back.
    """
    fresh = dedupe_first(df, keys, order)
    stored = _stored(df.sparkSession, path)
    if stored is not None:
        shared = [c for c in partition_by or [] if c in keys]
        if shared:
            wanted = df.select(*shared).distinct()
            stored = stored.join(wanted, same(stored, wanted, shared), "left_semi")
        known = stored.select(*keys)
        fresh = fresh.join(known, same(fresh, known, keys), "left_anti")
    append(fresh, path, partition_by)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Reload: replace the table. The input may read the same table, so it is staged first."""
    staged = cut_lineage(df, "overwrite")
    writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def snapshot(df: DataFrame, folder: str, name: str, stamp: str) -> str:
    """Copy of a table named <name>_backup_<stamp>; an existing one is an error."""
    path = f"{folder.rstrip('/')}/{name}_backup_{stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def restore(backup: DataFrame, mapping: dict[str, str], columns: dict[str, str]) -> DataFrame:
    """Backup rows in a new layout: mapped columns are renamed, columns it lacks are NULL."""
    backup = backup.withColumnsRenamed(mapping)
    return backup.select(
        *[(F.col(c) if c in backup.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
    )


def fanout(df: DataFrame, keys: list[str], order: list, raw_path: str, unique_path: str) -> None:
    """Write all rows to one table and the first row per key to another, from one evaluation."""
    staged = cut_lineage(df, "fanout")
    append(staged, raw_path)
    append_new(staged, unique_path, keys, order)


def write_both(detail: DataFrame, unified: DataFrame, detail_path: str, unified_path: str) -> None:
    """A shop's detail rows and their unified form."""
    append(detail, detail_path)
    append(unified, unified_path, ["account_name"])


def export_csv(df: DataFrame, folder: str, cc: str, mall: str, stamp: str) -> str:
    """CSV folder named <stamp>_<cc>_<mall>.csv, with header, UTF-8."""
    path = f"{folder.rstrip('/')}/{stamp}_{cc}_{mall}.csv"
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def export_json(df: DataFrame, folder: str, meta: dict[str, str], value: str = "retailprice") -> tuple[str, str]:
    """Result records as JSON lines and a one-row metadata file with the totals beside them."""
    base = folder.rstrip("/")
    info = df.agg(F.count(F.lit(1)).alias("total_products"), F.count(value).alias("successful_crawls"))
    for key, text in meta.items():
        info = info.withColumn(key, F.lit(text))
    df.write.json(f"{base}/results")
    info.coalesce(1).write.json(f"{base}/crawl_info")
    return f"{base}/results", f"{base}/crawl_info"


def export_report(frames: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder per part of a report."""
    for name, frame in frames.items():
        frame.write.option("header", True).csv(f"{folder.rstrip('/')}/{name}")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
