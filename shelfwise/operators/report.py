"""Price statistics, coverage reports and table profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage

PRICE = "decimal(12,2)"
BUCKET = 1000


def amount_counts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``by, _v, _b, _n``: how often each amount occurs in each group, and the amount's bucket of 1000; written once for its several uses.

    decimal(12,2) bounds it: 100,000 amounts per bucket, and one bucket per 1000 of range, whatever the number of rows.
    """
    amount = F.col(value).cast(PRICE)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, amount.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    return cut_lineage(counts.withColumn("_b", F.floor(F.col("_v") / BUCKET).cast("bigint")), "amounts")


def price_stats(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Mean, minimum, maximum, exact median and row count per group, from one pass over the rows.

    The rows become counts of amounts (``amount_counts``); those are summed per bucket, and the buckets per group. The bucket of the
    middle rank is found from the (few) bucket totals, and only that bucket is looked into. NULL is a group.
    """
    keys = by or ["_all"]
    counts = amount_counts(df if by else df.withColumn("_all", F.lit(1)), value, keys)
    weight = F.col("_v").cast("decimal(20,2)") * F.col("_n").cast("decimal(18,0)")
    buckets = counts.groupBy(*keys, "_b").agg(F.sum("_n").alias("_n"), F.sum(weight).alias("_sum"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    group = Window.partitionBy(*keys)
    upto = F.sum("_n").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    over = {"_total": F.sum("_n"), "_all_sum": F.sum("_sum"), "_least": F.min("_min"), "_most": F.max("_max")}
    totals = buckets.withColumns({"_upto": upto, **{name: total.over(group) for name, total in over.items()}})
    lower = F.floor((F.col("_total") + 1) / 2)
    upper = F.floor(F.col("_total") / 2) + 1
    holds = lambda rank: (rank > F.col("_upto") - F.col("_n")) & (rank <= F.col("_upto"))
    middle = totals.where(holds(lower) | holds(upper)).select(
        *[F.col(c).alias(f"_of_{c}") for c in [*keys, "_b"]], (F.col("_upto") - F.col("_n")).alias("_before"), lower.alias("_lower"), upper.alias("_upper"), *over,
    )
    match = F.col("_b") == F.col("_of__b")
    for c in keys:
        match &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    in_bucket = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(middle, match).withColumn("_rank", F.col("_before") + F.sum("_n").over(in_bucket))
    at = lambda rank: F.min(F.when(F.col("_rank") >= F.col(rank), F.col("_v")))
    # A group has one or two middle buckets; the smallest amount at or past the rank is the answer.
    out = ranked.groupBy(*keys).agg(
        (F.first("_all_sum").cast("double") / F.first("_total")).alias("mean_price"),
        F.first("_least").alias("min_price"), F.first("_most").alias("max_price"), F.first("_total").alias("priced"),
        ((at("_lower") + at("_upper")) / 2).cast("decimal(14,3)").alias("median_price"),
    )
    if by:
        return out
    # A table without prices has one row, of NULLs and a count of 0.
    out = out.drop("_all")
    return out.groupBy().agg(*[F.max(c).alias(c) for c in out.columns if c != "priced"], F.coalesce(F.max("priced"), F.lit(0)).alias("priced"))


def exact_median(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Exact median per group, as decimal(14,3), without holding a group's values in one task."""
    return price_stats(df, value, by).select(*by, "median_price")


def daily_history(df: DataFrame, now, days: int, value: str = "retailprice", at: str = "crawl_datetime") -> DataFrame:
    """Rows, priced rows, brands and items per day over the last ``days`` days."""
    since = F.lit(now).cast("timestamp") - F.make_interval(days=F.lit(days))
    # Counts per day, brand and item first: the two distinct counts then expand the few sums, not the rows.
    sums = df.where(F.col(at) >= since).groupBy(F.to_date(at).alias("date"), "brand", "item")
    sums = sums.agg(F.count(F.lit(1)).alias("_n"), F.count(value).alias("_priced"))
    return sums.groupBy("date").agg(
        F.sum("_n").alias("total_count"),
        F.sum("_priced").alias("with_price"),
        F.countDistinct("brand").alias("brands"),
        F.countDistinct("item").alias("items"),
    )


def brand_success(df: DataFrame, value: str = "retailprice") -> DataFrame:
    """Rows, priced rows and success rate (one decimal) per brand; total counts all rows."""
    n, ok = F.count(F.lit(1)), F.count(value)
    return df.groupBy("brand").agg(
        n.alias("total"), ok.alias("success"), F.round(ok * 100 / n, 1).alias("success_rate")
    )


def capacity_stats(df: DataFrame, value: str = "retailprice") -> DataFrame:
    """Mean price and rows per capacity, priced rows only."""
    return df.where(F.col(value).isNotNull()).groupBy("capacity").agg(
        (F.sum(value).cast("double") / F.count(value)).alias("mean_price"), F.count(value).alias("priced")
    )


def brand_counts(df: DataFrame, value: str = "retailprice") -> DataFrame:
    """Priced rows per brand, most first."""
    return df.where(F.col(value).isNotNull()).groupBy("brand").agg(F.count(F.lit(1)).alias("priced")).orderBy(
        F.desc("priced"), "brand"
    )


def _rate(ok: Column, n: Column) -> Column:
    return F.coalesce(ok * 100 / F.nullif(n, F.lit(0)), F.lit(0.0))


def success_rate(df: DataFrame, value: str = "retailprice") -> DataFrame:
    """Share of priced rows in percent, 0 for an empty table."""
    return df.agg(_rate(F.count(F.col(value)), F.count(F.lit(1))).alias("success_rate"))


def summary(df: DataFrame, value: str = "retailprice", extra: dict[str, str] | None = None) -> DataFrame:
    """Metric / value rows: totals, success rate with two decimals, then the given constants."""
    n, ok = F.count(F.lit(1)), F.count(F.col(value))
    wide = df.agg(
        n.cast("string").alias("Total Products"),
        ok.cast("string").alias("Products with Price"),
        (n - ok).cast("string").alias("Products without Price"),
        F.round(_rate(ok, n), 2).cast("string").alias("Success Rate (%)"),
    )
    for metric, constant in (extra or {}).items():
        wide = wide.withColumn(metric, F.lit(constant))
    return wide.unpivot([], wide.columns, "metric", "value")


def abnormal_prices(df: DataFrame, value: str = "retailprice", lo: float = 10, hi: float = 10000) -> DataFrame:
    """Priced rows outside lo..hi."""
    return df.where((F.col(value) < lo) | (F.col(value) > hi))


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Total, non-null and null rows per column, in one pass."""
    wide = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(c).alias(c) for c in cols])
    long = wide.unpivot(["_total"], cols, "column_name", "non_null")
    return long.select(
        "column_name", F.col("_total").alias("total"), "non_null", (F.col("_total") - F.col("non_null")).alias("nulls")
    )


def today_count(df: DataFrame, today, at: str = "crawl_datetime") -> DataFrame:
    """Rows stored on a day, as a half-open range so that the scan can skip row groups."""
    day = F.lit(today).cast("date").cast("timestamp")
    rows = df.where((F.col(at) >= day) & (F.col(at) < day + F.make_interval(days=F.lit(1))))
    return rows.agg(F.count(F.lit(1)).alias("today_count"))


def table_counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def reconcile(sources: dict[str, DataFrame], target: DataFrame) -> DataFrame:
    """Rows read per account, rows in the target, and the difference as errors."""
    read = reduce(
        DataFrame.unionByName,
        [df.agg(F.lit(name).alias("account_name"), F.count(F.lit(1)).alias("read_rows")) for name, df in sources.items()],
    )
    stored = target.groupBy("account_name").agg(F.count(F.lit(1)).alias("inserted_rows"))
    out = read.join(stored, "account_name", "left").withColumn("inserted_rows", F.coalesce("inserted_rows", F.lit(0)))
    return out.withColumn("errors", F.col("read_rows") - F.col("inserted_rows"))


def report_frames(df: DataFrame, value: str = "retailprice", extra: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The three parts of a report: all rows, priced rows, summary."""
    return {
        "All_Results": df,
        "With_Prices": df.where(F.col(value).isNotNull()),
        "Summary": summary(df, value, extra),
    }


def latest(df: DataFrame, order: str, n: int, text: str | None = None) -> DataFrame:
    """The n newest rows, with the length of a text column."""
    out = df.orderBy(F.desc(order)).limit(n)
    return out.withColumn("text_length", F.length(text)) if text else out


def head_by(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(*keys).limit(n)


def sample_failures(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n failures with their reason, and the total number of failures."""
    failed = df.where(F.col("outcome") != "ok")
    total = failed.agg(F.count(F.lit(1)))
    return failed.orderBy(*order).limit(n).withColumn("total_failures", total.scalar())
