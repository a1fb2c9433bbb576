"""Retail views over the given tables.

The tables are not retail tables, so every query starts from a projection of them. A view is a list
of (column, expression); the expressions are SQL that Spark and the checking engine both read, apart
from the time formats, which stand as tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK_TOKENS = {
    "@batch": "date_format(ts, 'yyyyMMdd') || '_000000'",
    "@crawl": "date_format(ts, 'yyyyMMddHHmmssSSSS')",
}
CHECK_TOKENS = {
    "@batch": "strftime(ts, '%Y%m%d') || '_000000'",
    "@crawl": "strftime(ts, '%Y%m%d%H%M%S') || substr(strftime(ts, '%f'), 1, 4)",
}

ACCOUNT = "case event_id % 3 when 0 then 'Amazon' when 1 then 'Bestbuy' else 'Walmart' end"
URL = (
    "case when event_id % 50 = 7 then null when event_id % 50 = 9 then '' else "
    "'https://shop.example.com/tv/dp/B' || lpad(cast(user_id as string), 9, '0') end"
)
NAME = "'Smart TV ' || cast(user_id % 97 as string)"
VALUE = "cast(value as decimal(12,2))"
MORE = "cast(value as decimal(12,2)) + cast(10 as decimal(12,2))"
COUNTRY = (
    "case p_partkey % 9 when 0 then 'it' when 1 then 'de' when 2 then 'fr' when 3 then 'es' when 4 then 'in' "
    "when 5 then 'nl' when 6 then 'gb' when 7 then 'usa' else 'pl' end"
)
PART_PRICE = "cast(cast(p_retailprice as decimal(12,2)) + cast(p_size * 100 as decimal(12,2)) as decimal(12,2))"

# name -> (table, filter or None, columns)
VIEWS: dict[str, tuple[str, str | None, list[tuple[str, str]]]] = {
    # Listing feeds: four event types are the four feeds, one batch per day.
    "listing": ("events", "event_type <> 'error'", [
        ("listing_id", "event_id"),
        ("account_name", ACCOUNT),
        ("source", "case event_type when 'view' then 'main' when 'click' then 'bsr' when 'purchase' then 'promotion' "
                   "else 'trend' end"),
        ("batch_id", "@batch"),
        ("rank", "case when event_id % 61 = 5 then null else cast(event_id % 300 + 1 as int) end"),
        ("product_url", URL),
        ("listing_url", "case when event_id % 50 = 7 then null when event_id % 7 = 0 then 'https://shop.example.com/o/' || "
                        "cast(user_id as string) else 'https://shop.example.com/tv/dp/B' || "
                        "lpad(cast(user_id as string), 9, '0') || '/ref=' || cast(event_id % 4 as string) end"),
        ("retailer_sku_name", NAME),
        ("final_sku_price", f"case when event_id % 6 = 0 then null when event_id % 37 = 0 then '' else '$' || "
                            f"cast({VALUE} as string) end"),
        ("original_sku_price", f"case when event_id % 4 = 0 then null else '$' || cast({MORE} as string) end"),
        ("offer", "case when event_id % 9 = 0 then null else cast(event_id % 5 as string) end"),
        ("pick_up_availability", "case when event_type = 'purchase' then null else 'Pickup ' || "
                                 "cast(event_id % 3 as string) end"),
        ("sku_status", "case event_id % 8 when 0 then 'Rollback' when 1 then 'Sponsored' end"),
        ("promotion_type", "case when event_type = 'purchase' then 'Deal ' || cast(event_id % 4 as string) end"),
        ("page_number", "cast(event_id % 20 + 1 as int)"),
        ("position", "case when event_id % 13 = 0 then 'x' when event_id % 17 = 0 then null else "
                     "cast(event_id % 48 as string) end"),
        ("crawl_strdatetime", "@crawl"),
    ]),
    # Unified rows with missing prices.
    "unified": ("events", None, [
        ("id", "event_id"),
        ("account_name", ACCOUNT),
        ("product_url", URL),
        ("retailer_sku_name", NAME),
        ("final_sku_price", f"case when event_id % 5 = 0 then null when event_id % 35 = 1 then '' else '$' || "
                            f"cast({VALUE} as string) end"),
        ("original_sku_price", f"case when event_id % 4 = 0 then null else '$' || cast({MORE} as string) end"),
        ("savings", "case when event_id % 11 = 0 then '$1.00' end"),
        ("crawl_strdatetime", "@crawl"),
    ]),
    # Detail rows: the batch or the crawl time is unknown for some.
    "detail": ("events", None, [
        ("id", "event_id"),
        ("account_name", ACCOUNT),
        ("product_url", URL),
        ("retailer_sku_name", NAME),
        ("item", "case when event_id % 3 = 0 then null else 'M' || cast(user_id as string) || '-' || "
                 "cast(event_id % 4 as string) end"),
        ("status_badge", "case when event_id % 5 = 0 then 'Rollback' end"),
        ("final_sku_price", f"case when event_id % 3 = 0 then null else '$' || cast({VALUE} as string) end"),
        ("original_sku_price", f"case when event_id % 2 = 0 then null else '$' || cast({MORE} as string) end"),
        ("batch_id", "case when event_id % 10 = 9 then null else @batch end"),
        ("crawl_strdatetime", "case when event_id % 7 = 3 then null else @crawl end"),
    ]),
    # Attempt log: an error is an attempt without a price.
    "log": ("events", None, [
        ("url", "'https://shop.example.com/' || cast(user_id as string)"),
        ("retailprice", f"case when event_type = 'error' then null else {VALUE} end"),
        ("title", "case when event_id % 3 = 0 then null else 'Title ' || cast(user_id as string) end"),
        ("ts", "ts"),
        ("attempt_id", "event_id"),
    ]),
    # Catalogue of tracked products.
    "targets": ("part", None, [
        ("url", "'https://shop.example.com/' || cast(p_partkey as string)"),
        ("partkey", "p_partkey"),
        ("country", COUNTRY),
        ("mall_name", "case when p_size % 2 = 0 then 'amazon' else 'coolblue' end"),
        ("is_active", "p_size % 7 <> 0"),
        ("retailerid", "'R' || cast(p_partkey % 10 as string)"),
        ("channel", "case when p_size % 5 = 0 then null else 'Offline' end"),
        ("retailersku", "'S' || cast(p_partkey as string)"),
        ("brand", "p_brand"),
        ("brand_eng", "case when p_size % 3 = 0 then '' when p_size % 3 = 1 then null else upper(p_brand) end"),
        ("form_factor", "p_type"),
        ("seg_lv1", "p_type"),
        ("seg_lv2", "p_name"),
        ("seg_lv3", "cast(p_size as string)"),
        ("capacity", "cast(p_size as string) || 'GB'"),
        ("item", "p_name"),
        ("vat", "case when p_size % 4 = 0 then null else 'x' end"),
    ]),
    # Prices written the way each country writes them, some of them unreadable.
    "price_text": ("part", None, [
        ("partkey", "p_partkey"),
        ("country", COUNTRY),
        ("plain", f"cast({PART_PRICE} as string)"),
        ("odd", "p_size % 10"),
    ]),
    "master": ("part", None, [
        ("id", "p_partkey"),
        ("product_name", "p_name"),
        ("item", "case when p_partkey % 4 = 0 then null else p_brand || '-' || cast(p_size as string) end"),
    ]),
    # Catalogue prices at scale.
    "sales": ("lineitem", None, [
        ("orderkey", "l_orderkey"),
        ("linenumber", "l_linenumber"),
        ("partkey", "l_partkey"),
        ("suppkey", "l_suppkey"),
        ("brand", "'Brand ' || cast(l_partkey % 25 as string)"),
        ("item", "cast(l_partkey as string)"),
        ("capacity", "cast(cast(l_quantity as int) as string) || 'GB'"),
        ("retailprice", "case when l_linenumber = 4 then null else cast(l_extendedprice as decimal(12,2)) end"),
        ("crawl_datetime", "l_shipdate"),
    ]),
    "reviews": ("conversations", None, [
        ("product", "conv_id"), ("ordinal", "turn"), ("role", "role"), ("text", "text"),
    ]),
    "raw_data": ("events", None, [
        ("id", "event_id"),
        ("mall_name", ACCOUNT),
        ("page_number", "cast(event_id % 20 + 1 as int)"),
        ("position", "cast(event_id % 48 as int)"),
        ("code", "case when event_id % 29 = 0 then ' ' else 'B' || cast(user_id as string) end"),
        ("retailer_sku_name", "case when event_id % 23 = 0 then '' when event_id % 31 = 0 then null else "
                              "'TV ' || cast(user_id % 60 as string) || case when event_id % 10 = 0 then ' New' else '' end end"),
        ("product_url", "'https://shop.example.com/tv/' || cast(user_id as string) || '/sr=8-' || "
                        "cast(event_id % 330 + 1 as string)"),
        ("sr", "cast(event_id % 330 + 1 as int)"),
        ("collected_at", "ts"),
    ]),
    "pages": ("pages", None, [("page_id", "page_id"), ("url", "url"), ("html", "html")]),
}


def _expand(text: str, tokens: dict[str, str]) -> str:
    for token, expression in tokens.items():
        text = text.replace(token, expression)
    return text


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The view as a DataFrame."""
    table, where, columns = VIEWS[name]
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    if where:
        df = df.where(where)
    return df.selectExpr(*[f"{_expand(e, SPARK_TOKENS)} as `{c}`" for c, e in columns])


def view_sql(name: str) -> str:
    """The view as a named subquery: ``v_name as (...)``."""
    table, where, columns = VIEWS[name]
    select = ", ".join(f"{_expand(e, CHECK_TOKENS)} as {c}" for c, e in columns)
    return f"v_{name} as (select {select} from {table}" + (f" where {where})" if where else ")")


def check_sql(body: str, *views: str, extra: str = "") -> str:
    """A checking query: the views (and further named subqueries) it uses, then its body."""
    parts = [view_sql(v) for v in views] + ([extra] if extra else [])
    return f"with {', '.join(parts)} {body}" if parts else body
