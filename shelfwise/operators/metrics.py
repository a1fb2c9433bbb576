"""Figures of a frame counted while it is written: no second pass over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfwise.functions.text import blank_to_null
from shelfwise.operators.backfill import RULES, backfill_prices
from shelfwise.operators.quality import KINDS


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], where: Column | None = None, partition_by: list[str] | None = None) -> dict[str, int]:
    """Append ``df`` (the rows that meet ``where``) to a Parquet table and return aggregates over all of ``df``, from the same job.

    The figures are those of the rows that the job computed; a task that is run again counts once.
    """
    seen = Observation()
    rows = df.observe(seen, *[value.alias(name) for name, value in metrics.items()])
    rows = rows.where(where) if where is not None else rows
    writer = rows.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return {name: seen.get[name] or 0 for name in metrics}


def save_required(df: DataFrame, cols: list[str], path: str) -> dict[str, int]:
    """Store the rows in which every named text is present; how many were kept and dropped, in all and per text."""
    missing = {c: blank_to_null(c).isNull() for c in cols}
    ok = F.lit(True)
    for lacks in missing.values():
        ok = ok & ~lacks
    metrics = {"kept": F.count_if(ok), "dropped": F.count_if(~ok)} | {f"without_{c}": F.count_if(lacks) for c, lacks in missing.items()}
    return write_observed(df, path, metrics, ok)


def save_backfilled(unified: DataFrame, detail: DataFrame, listing: DataFrame, prefer: list[str], path: str) -> dict[str, int]:
    """Fill missing prices and store all rows; per account, rows updated and rows that failed: a price was missing and nothing was found."""
    filled = backfill_prices(unified, detail, listing, prefer)
    lacks = F.col("final_sku_price").isNull() | F.col("original_sku_price").isNull()
    metrics = {}
    for rule in RULES:
        own = F.col("account_name") == rule.account
        metrics[f"{rule.account}_updated"] = F.count_if(own & F.col("backfilled"))
        # A row that was filled in part is updated; one that still lacks a price and was not touched failed.
        metrics[f"{rule.account}_failed"] = F.count_if(own & lacks & ~F.col("backfilled"))
    return write_observed(filled, path, metrics)


def save_issues(log: DataFrame, path: str) -> dict[str, int]:
    """Store an issue log; its total and its counts per type."""
    metrics = {"total": F.count(F.lit(1))} | {kind: F.count_if(F.col("issue_type") == kind) for kind in KINDS}
    return write_observed(log, path, metrics)


def save_reconciled(rows: DataFrame, accounts: list[str], valid: Column, path: str) -> dict[str, int]:
    """Store the valid rows; rows read, inserted and in error per account."""
    metrics = {}
    for account in accounts:
        own = F.col("account_name") == account
        metrics |= {f"{account}_read": F.count_if(own), f"{account}_inserted": F.count_if(own & valid), f"{account}_errors": F.count_if(own & ~valid)}
    return write_observed(rows, path, metrics, valid)


