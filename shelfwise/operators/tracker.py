"""Country price tracker: targets, retries, fact rows, attempt log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import blank_to_null
from shelfwise.functions.clock import strdatetime
from shelfwise.operators.skew import join_one


def crawl_targets(targets: DataFrame, country: str, mall: str, limit: int | None = None) -> DataFrame:
    """Active targets of one country and mall; ``limit`` is the caller's sample size."""
    out = targets.where((F.col("country") == country) & (F.col("mall_name") == mall) & F.col("is_active"))
    return out.limit(limit) if limit else out


def active_pages(pages: DataFrame, mall: str) -> DataFrame:
    """Active list pages of a mall in page order."""
    return pages.where((F.col("mall_name") == mall) & F.col("is_active")).select("page_number", "url").orderBy("page_number")


def failed_counts(log: DataFrame, now, hours: int = 24, by: tuple[str, ...] = ("url",)) -> DataFrame:
    """Failures (no price) per URL, or per other columns, in the ``hours`` before ``now``."""
    since = F.lit(now).cast("timestamp") - F.make_interval(hours=F.lit(hours))
    recent = log.where(F.col("retailprice").isNull() & (F.col("crawl_datetime") >= since))
    return recent.groupBy(*by).agg(F.count(F.lit(1)).alias("fail_count"))


def retry_targets(
    targets: DataFrame, log: DataFrame, now, hours: int = 24, max_fail: int = 3, by: tuple[str, ...] = ("url",)
) -> DataFrame:
    """Targets with fewer than ``max_fail`` recent failures, each once, with the failure count.

    ``by`` names what failures are counted for; with a country in it, a URL's failures in other countries do not count. Order by ``fail_count`` descending for a work queue; the frame itself is not sorted.
    """
    counts = failed_counts(log, now, hours, by)
    out = join_one(targets, counts, [*by]).withColumn("fail_count", F.coalesce("fail_count", F.lit(0)))
    return out.where(F.col("fail_count") < max_fail).distinct()


def price_rows(targets: DataFrame, observed: DataFrame) -> DataFrame:
    """Price facts: catalogue attributes plus what was observed; no observation -> NULL price row.

    Fixed defaults: channel 'Online', vat 'o', brand_eng the brand.
    """
    out = targets.join(observed, "url", "left")
    return out.select(
        "retailerid",
        F.col("country").alias("country_code"),
        "ships_from",
        F.coalesce("channel", F.lit("Online")).alias("channel"),
        "retailersku",
        "brand",
        F.coalesce(blank_to_null("brand_eng"), "brand").alias("brand_eng"),
        "form_factor",
        F.col("seg_lv1").alias("segment_lv1"),
        F.col("seg_lv2").alias("segment_lv2"),
        F.col("seg_lv3").alias("segment_lv3"),
        "capacity",
        "item",
        "retailprice",
        "sold_by",
        "imageurl",
        F.col("url").alias("producturl"),
        "crawl_datetime",
        strdatetime("crawl_datetime").alias("crawl_strdatetime"),
        "title",
        F.coalesce("vat", F.lit("o")).alias("vat"),
    )


def attempt_log(facts: DataFrame) -> DataFrame:
    """Log rows derived from price facts: success where there is a price."""
    ok = F.col("retailprice").isNotNull()
    return facts.select(
        "country_code",
        F.col("producturl").alias("url"),
        F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.when(~ok, F.lit("Price not found")).alias("error_message"),
        "retailprice",
        "crawl_datetime",
    )
