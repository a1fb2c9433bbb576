"""Sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def split_page_urls(lines: DataFrame, value: str = "value") -> DataFrame:
    """'page,url' lines; only the first comma separates, lines without a page number are left out."""
    parts = F.split(F.col(value), ",", 2)
    rows = lines.select(
        F.trim(parts[0]).try_cast("int").alias("page_number"), F.trim(F.try_element_at(parts, F.lit(2))).alias("url")
    )
    return rows.where(F.col("page_number").isNotNull() & (F.col("url") != ""))


def read_page_urls(spark: SparkSession, path: str) -> DataFrame:
    """Page list from a text file of 'page,url' lines."""
    return split_page_urls(spark.read.text(path))


def read_pages(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Stored pages: a Parquet page table, or a folder of one-page files (``form='files'``).

    Files are read whole, one row each; ``path`` orders them. Files in folders below count, at any depth; Spark lists
    the folders directly below ``path`` in parallel, each in one task.
    """
    if form == "parquet":
        return spark.read.parquet(path)
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
