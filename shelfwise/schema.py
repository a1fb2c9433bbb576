"""Canonical schemas and schema evolution."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.clock import crawl_time

# The unified table, in its column order.
UNIFIED = """
    item string, account_name string, page_type string, count_of_reviews int, retailer_sku_name string,
    product_url string, star_rating string, count_of_star_ratings int, screen_size string, sku_popularity string,
    final_sku_price string, original_sku_price string, savings string, discount_type string, offer string,
    pick_up_availability string, shipping_availability string, delivery_availability string, shipping_info string,
    available_quantity_for_purchase string, inventory_status string, sku_status string,
    retailer_membership_discounts string, detailed_review_content string, summarized_review_content string,
    top_mentions string, recommendation_intent string, main_rank int, bsr_rank int, rank_1 string, rank_2 string,
    promotion_rank int, trend_rank int, number_of_ppl_purchased_yesterday int, number_of_ppl_added_to_carts int,
    retailer_sku_name_similar string, estimated_annual_electricity_use string, promotion_type string,
    calendar_week string, crawl_strdatetime timestamp
"""
UNIFIED_COLUMNS = [tuple(part.split()) for part in UNIFIED.replace("\n", " ").split(",")]
ACCOUNTS = ["Amazon", "Bestbuy", "Walmart"]


def align(df: DataFrame, account: str, rename: dict[str, str] | None = None) -> DataFrame:
    """Project a shop's table onto the unified schema: rename, reorder, cast, NULL-fill.

    Crawl times, digits in the shops' tables, become timestamps.
    """
    df = df.withColumnsRenamed(rename or {})
    have = set(df.columns)
    out = []
    for name, kind in UNIFIED_COLUMNS:
        if name == "account_name":
            out.append(F.lit(account).alias(name))
        elif name == "crawl_strdatetime" and name in have and dict(df.dtypes)[name] == "string":
            out.append(F.coalesce(crawl_time(name), F.col(name).try_cast(kind)).alias(name))
        elif name in have:
            out.append(F.col(name).try_cast(kind).alias(name))
        else:
            out.append(F.lit(None).cast(kind).alias(name))
    return df.select(*out)


def unify(*frames: DataFrame) -> DataFrame:
    """Union of aligned tables; columns are matched by name and filled with NULL where absent."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


@dataclass(frozen=True)
class Evolution:
    """Schema changes, applied in the order rename, add, cast, drop, order.

    Every step is guarded: absent columns are not renamed, cast or dropped, present ones not added.
    """

    rename: dict[str, str] = field(default_factory=dict)
    add: dict[str, str] = field(default_factory=dict)
    cast: dict[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    order: tuple[str, ...] = ()


def evolve(df: DataFrame, change: Evolution) -> DataFrame:
    """Apply schema changes; applying them twice changes nothing more."""
    out = df.withColumnsRenamed({a: b for a, b in change.rename.items() if b not in df.columns})
    out = out.withColumns({c: F.lit(None).cast(t) for c, t in change.add.items() if c not in out.columns})
    out = out.withColumns({c: F.col(c).cast(t) for c, t in change.cast.items() if c in out.columns})
    out = out.drop(*change.drop)
    if change.order:
        head = [c for c in change.order if c in out.columns]
        out = out.select(*head, *[c for c in out.columns if c not in head])
    return out


def read_evolved(spark: SparkSession, folders: list[str], change: Evolution, key: str = "generation") -> DataFrame:
    """Files written under several schemas, as one table of the newest, without rewriting any.

    Each folder is one generation of the table. The generations are read together by name, columns that only some have are NULL in the
    others, and a renamed column takes its old name's value where the new one is not there. Columns whose type changed are cast as
    ``change.cast`` says before they meet; columns named in ``change.drop`` go. ``key`` numbers the generations from 1, in the order of ``folders``; a
    filter on it or on any column reaches the files.
    """
    parts = []
    for number, folder in enumerate(folders, 1):
        rows = spark.read.option("mergeSchema", True).parquet(folder)
        for old, new in change.rename.items():
            if old in rows.columns and new in rows.columns:
                rows = rows.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old)
            elif old in rows.columns:
                rows = rows.withColumnRenamed(old, new)
        known = {c: t for c, t in change.cast.items() if c in rows.columns}
        digits = [c for c, t in known.items() if t == "timestamp" and dict(rows.dtypes)[c] == "string"]
        rows = rows.withColumns({c: F.coalesce(crawl_time(c), F.col(c).try_cast(t)) if c in digits else F.col(c).try_cast(t) for c, t in known.items()})
        parts.append(rows.drop(*change.drop).withColumn(key, F.lit(number)))
    return evolve(unify(*parts), Evolution(add=change.add, order=(*change.order,)))


def describe_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Table, column, type and nullability; reads schemas only, no data."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, type string, nullable boolean")


def catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The same for the tables of the session catalog; temporary views are in no named database."""
    names = [t.name for t in spark.catalog.listTables(database) if not (database and t.isTemporary)]
    return describe_columns(spark, {n: spark.table(f"{database}.{n}" if database else n) for n in names})
