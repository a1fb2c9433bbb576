"""Inserts, updates and lookups as dataflow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.order import newest_key
from shelfwise.operators.listing import dedupe_first
from shelfwise.operators.skew import join_one


def partial_key(keys: list[str]) -> Column:
    """Whether a key has a NULL in it, and so equals no other key."""
    return F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x)


def new_only(incoming: DataFrame, stored: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Incoming rows whose key is not stored yet, first row per key.

    A key with a NULL in it equals no other key, as in the source database: such rows are all new.
    """
    partial = partial_key(keys)
    full = dedupe_first(incoming.where(~partial), keys, order).join(stored.select(*keys), keys, "left_anti")
    return full.select(incoming.columns).unionByName(incoming.where(partial))


def insert_absent(incoming: DataFrame, stored: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Insert, do nothing on conflict: the stored rows plus the new ones."""
    return stored.unionByName(new_only(incoming, stored, keys, order))


def upsert(incoming: DataFrame, stored: DataFrame, keys: list[str], cols: list[str], order: list[Column | str]) -> DataFrame:
    """Insert, on conflict update ``cols``; other columns of stored rows stay.

    ``order`` settles several incoming rows of one key (first wins). Stored keys are unique, but for keys with a NULL in
    them: such a key equals no other, as in the source database, so these rows never conflict, are all inserted, each time.
    """
    partial = partial_key(keys)
    new = dedupe_first(incoming.where(~partial), keys, order).withColumn("_new", F.lit(True)).alias("n")
    old = stored.withColumn("_old", F.lit(True)).alias("o")
    both = old.join(new, keys, "full_outer")
    out = [F.col(k) for k in keys]
    for c in stored.columns:
        if c in keys:
            continue
        take_new = F.col("n._new").isNotNull() & (F.lit(c in cols) | F.col("o._old").isNull())
        out.append(F.when(take_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    inserted = incoming.where(partial).select(stored.columns)
    return both.select(*out).select(stored.columns).unionByName(inserted)


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns on the rows that meet the condition."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def fill_default(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Replace NULLs by constants."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def latest_values(rows: DataFrame, key: str, value: str, order: list[str], name: str) -> DataFrame:
    """Newest non-null value per key."""
    known = rows.where(F.col(value).isNotNull() & F.col(key).isNotNull())
    return known.groupBy(key).agg(F.max_by(value, newest_key(*order)).alias(name))


def lookup_latest(left: DataFrame, right: DataFrame, key: str, value: str, order: list[str], name: str) -> DataFrame:
    """Add the newest value the right side has for the left row's key."""
    return join_one(left, latest_values(right, key, value, order, name), [key])


def fill_from_peers(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """Fill NULLs with the newest value among rows of the same key.

    Only the rows with a NULL are joined; complete rows pass by without a shuffle.
    """
    filled = lookup_latest(df.where(F.col(value).isNull()), df, key, value, order, "_peer")
    filled = filled.withColumn(value, F.col("_peer")).select(df.columns)
    return df.where(F.col(value).isNotNull()).unionByName(filled)


def master_items(products: DataFrame, details: DataFrame) -> DataFrame:
    """Item per compared product: the page's own item at position 1, else the newest by name."""
    out = lookup_latest(
        products, details.withColumnRenamed("retailer_sku_name", "product_name"),
        "product_name", "item", ["crawl_strdatetime", "item"], "_found",
    )
    return out.withColumn("item", F.when(F.col("pos") == 1, F.col("current_item")).otherwise(F.col("_found"))).drop("_found")


def detail_with_listing(detail: DataFrame, merged: DataFrame, attrs: list[str]) -> DataFrame:
    """Detail rows with listing attributes; the status is the listing's, else the badge's."""
    out = join_one(detail, merged.select("product_url", "page_type", "sku_status", *attrs), ["product_url"])
    return out.withColumn("sku_status", F.coalesce("sku_status", "status_badge")).drop("status_badge")


def missing_pages(pages: DataFrame, rows: DataFrame, page: str = "page_number") -> DataFrame:
    """Configured active pages that no row was collected from."""
    return pages.where("is_active").select(page).distinct().join(rows.select(page).distinct(), page, "left_anti")


def valid_in(column: str, values: list[str]) -> Column:
    """Whether a value passes a domain check; NULL passes, as with a CHECK constraint."""
    return F.col(column).isNull() | F.col(column).isin(values)


def in_domain(df: DataFrame, column: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows by a domain check: (valid, invalid). Each side reads ``df``; ``valid_in`` flags rows in one pass."""
    ok = valid_in(column, values)
    return df.where(ok), df.where(~ok)


# Event channel names.
CHANNELS = {"Best Buy": "Bestbuy"}
CHANNEL_DOMAIN = ["Amazon", "Bestbuy", "Walmart"]


def norm_channel(c: Column | str) -> Column:
    """'Best Buy' -> 'Bestbuy'; other names stay."""
    out = F.col(c) if isinstance(c, str) else c
    result = None
    for raw, name in CHANNELS.items():
        result = F.when(out == raw, F.lit(name)) if result is None else result.when(out == raw, F.lit(name))
    return result.otherwise(out)
