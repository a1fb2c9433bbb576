"""Joins and aggregates that stay cheap when one key holds much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_one(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", null_safe: bool = False) -> DataFrame:
    """Join rows with a side that has one row per key.

    Such a side is usually an aggregate over the same key, and Spark would join the aggregate
    where it stands. Adaptive skew splitting, however, needs two inputs that are shuffled for the
    join. Joining on the key and its hash brings that about: the right side, one row per key, is
    shuffled once more, and a hot key's rows on the left are divided over as many tasks as their
    size asks for, each with a copy of the one right row. A small right side is still broadcast. With ``null_safe``,
    NULL keys equal each other.
    """
    hashed = lambda df: df.withColumn("_hash", F.xxhash64(*on))
    if null_safe:
        other = hashed(right).withColumnsRenamed({c: f"_of_{c}" for c in [*on, "_hash"]})
        match = F.col("_hash") == F.col("_of__hash")
        for c in on:
            match &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        return hashed(left).join(other, match, how).drop("_hash", "_of__hash", *[f"_of_{c}" for c in on])
    return hashed(left).join(hashed(right), [*on, "_hash"], how).drop("_hash")


def combine(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of some columns, combined by hashing, ahead of a maximum or minimum of text.

    Spark takes the extreme of a text column by sorting all rows of a task. Run over this frame, it
    sorts the few distinct values instead. The row count keeps the optimizer from folding the two
    aggregates back into one.
    """
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where("_rows > 0").drop("_rows")
