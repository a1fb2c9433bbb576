"""Listing feeds: latest batch, merging, ranks, duplicates, filters, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.money import null_if_no_seller, outcome
from shelfwise.functions.urls import product_code
from shelfwise.operators import dml, listing
from shelfwise.plans.registry import query
from shelfwise.plans.views import check_sql, view
from shelfwise.schema import ACCOUNTS

ATTRS = ["listing_id", "retailer_sku_name", "offer", "pick_up_availability", "sku_status"]
ORDER = ("rank", "listing_id")
LATEST = (
    "latest as (select * from v_listing l where batch_id = (select max(batch_id) from v_listing m where m.source = l.source "
    "and m.account_name is not distinct from l.account_name))"
)


def _position(feeds: list[str]) -> str:
    return "case source " + " ".join(f"when '{f}' then {i}" for i, f in enumerate(feeds)) + " end"


@query("latest_batch", check_sql("select listing_id, source, batch_id, product_url, rank from latest", "listing", extra=LATEST))
def latest_batch(spark, folder):
    rows = listing.latest_batch(view(spark, folder, "listing"))
    return rows.select("listing_id", "source", "batch_id", "product_url", "rank")


def _merge_sql(key: str, feeds: list[str], strict: bool = True, promo: bool = True) -> str:
    names = ", ".join(f"'{f}'" for f in feeds)
    ranks = ", ".join(
        f"{'max' if strict and i else 'min'}(case when source = '{f}' then rank end) as {f}_rank" for i, f in enumerate(feeds)
    )
    extra = (
        f"{LATEST}, picked as (select *, row_number() over (partition by {key} order by {_position(feeds)}, rank, listing_id) as rn from latest "
        f"where source in ({names}) and {key} <> ''), ranks as (select {key}, {ranks} from picked group by {key}), "
        f"promo as (select {key}, promotion_type from (select *, row_number() over (partition by {key} order by rank "
        f"{'desc' if strict else 'asc'} nulls last, listing_id {'desc' if strict else 'asc'}) as pn from picked where source = 'promotion') where pn = 1)"
    )
    columns = ", ".join(f"p.{a}" for a in ATTRS)
    rank_columns = ", ".join(f"r.{f}_rank" for f in feeds)
    body = (
        f"select p.{key}, p.source as page_type, {columns}, {rank_columns}{', q.promotion_type' if promo else ''} from picked p "
        f"join ranks r using ({key}) left join promo q using ({key}) where p.rn = 1"
    )
    return check_sql(body, "listing", extra=extra)


def _merged(spark, folder, feeds, **options):
    rows = listing.latest_batch(view(spark, folder, "listing"), domains={"account_name": None, "source": feeds})
    return listing.merge_feeds(rows, "product_url", ATTRS, feeds, ORDER, **options)


@query("merge_feeds", _merge_sql("product_url", listing.FEEDS[:3]))
def merge_feeds(spark, folder):
    return _merged(spark, folder, listing.FEEDS[:3])


@query("merge_feeds_best_rank", _merge_sql("product_url", listing.FEEDS[:3], strict=False))
def merge_feeds_best_rank(spark, folder):
    return _merged(spark, folder, listing.FEEDS[:3], strict_parity=False)


@query("merge_feeds_trend", _merge_sql("product_url", listing.FEEDS))
def merge_feeds_trend(spark, folder):
    return _merged(spark, folder, listing.FEEDS)


TREND_FIRST = ["main", "trend", "promotion"]


@query("merge_feeds_trend_first", _merge_sql("product_url", TREND_FIRST))
def merge_feeds_trend_first(spark, folder):
    return _merged(spark, folder, TREND_FIRST)


@query(
    "merge_feeds_by_account",
    check_sql(
        "select account_name, product_url, arg_min(source, place) as page_type, arg_min(listing_id, place) as listing_id, min(rank) filter (source = 'main') as main_rank, "
        "max(rank) filter (source = 'bsr') as bsr_rank, max(rank) filter (source = 'promotion') as promotion_rank from (select *, "
        "(case source when 'main' then 1 when 'bsr' then 2 else 3 end) * cast(1000000000000 as bigint) + coalesce(rank, 900000) * cast(1000000 as bigint) + listing_id as place from v_listing l where "
        "source <> 'trend' and product_url <> '' and batch_id = (select max(batch_id) from v_listing m where m.source = l.source and m.account_name = l.account_name)) group by all",
        "listing",
    ),
)
def merge_feeds_by_account(spark, folder):
    feeds = listing.FEEDS[:3]
    rows = listing.latest_batch(view(spark, folder, "listing"), {"account_name": ACCOUNTS, "source": feeds})
    return listing.merge_feeds(rows, ["account_name", "product_url"], ["listing_id"], feeds, ORDER).drop("promotion_type")


CODE = (
    "coded as (select *, coalesce(nullif(regexp_extract(listing_url, '/dp/([A-Z0-9]{10})', 1), ''), listing_url) as product_code from latest), "
    "picked as (select *, row_number() over (partition by product_code order by case source when 'main' then 1 else 2 end, rank, listing_id) as rn "
    "from coded where source in ('main', 'bsr') and product_code <> '')"
)


@query(
    "merge_by_code",
    check_sql(
        "select product_code, max(case when rn = 1 then source end) as page_type, max(case when rn = 1 then listing_id end) as listing_id, "
        "max(case when rn = 1 then listing_url end) as listing_url, min(case when source = 'main' then rank end) as main_rank, "
        "max(case when source = 'bsr' then rank end) as bsr_rank from picked group by product_code",
        "listing", extra=f"{LATEST}, {CODE}",
    ),
)
def merge_by_code(spark, folder):
    feeds = ["main", "bsr"]
    rows = listing.latest_batch(view(spark, folder, "listing"), domains={"account_name": None, "source": feeds})
    rows = rows.withColumn("product_code", product_code("listing_url"))
    merged = listing.merge_feeds(rows, "product_code", ["listing_id", "listing_url"], feeds, ORDER)
    return merged.drop("promotion_type")


@query(
    "merge_with_fill",
    check_sql(
        "select product_code, max(case when rn = 1 then source end) as page_type, max(case when rn = 1 then listing_id end) as listing_id, "
        "coalesce(max(case when rn = 1 then nullif(final_sku_price, '') end), arg_min(case when source = 'bsr' then final_sku_price end, "
        "case when source = 'bsr' and final_sku_price <> '' then coalesce(rank, 900000) * cast(1000000000 as bigint) + listing_id end)) as final_sku_price, "
        "coalesce(max(case when rn = 1 then nullif(original_sku_price, '') end), arg_min(case when source = 'bsr' then original_sku_price end, "
        "case when source = 'bsr' and original_sku_price <> '' then coalesce(rank, 900000) * cast(1000000000 as bigint) + listing_id end)) as original_sku_price, "
        "min(case when source = 'main' then rank end) as main_rank, max(case when source = 'bsr' then rank end) as bsr_rank "
        "from picked group by product_code",
        "listing", extra=f"{LATEST}, {CODE}",
    ),
)
def merge_with_fill(spark, folder):
    feeds, prices = ["main", "bsr"], ("final_sku_price", "original_sku_price")
    rows = listing.latest_batch(view(spark, folder, "listing"), domains={"account_name": None, "source": feeds})
    rows = rows.withColumn("product_code", product_code("listing_url"))
    merged = listing.merge_feeds(rows, "product_code", ["listing_id", *prices], feeds, ORDER, fill=prices)
    return merged.drop("promotion_type")


@query(
    "feed_order",
    check_sql(
        "select product_url, arg_min(source, (case source when 'main' then 1 when 'bsr' then 2 else 3 end) * cast(1000000000000 as bigint) + coalesce(rank, 900000) * cast(1000000 as bigint) + listing_id) "
        "as page_type from latest where source <> 'trend' and product_url <> '' group by product_url",
        "listing", extra=LATEST,
    ),
)
def feed_order(spark, folder):
    return listing.feed_order(_merged(spark, folder, listing.FEEDS[:3])).select("product_url", "page_type")


@query(
    "order_by_rank",
    check_sql("select listing_id, source, rank from latest order by source, rank nulls last, listing_id", "listing", extra=LATEST),
)
def order_by_rank(spark, folder):
    rows = listing.latest_batch(view(spark, folder, "listing"))
    return rows.select("listing_id", "source", "rank").orderBy("source", F.col("rank").asc_nulls_last(), "listing_id")


@query(
    "dup_count",
    check_sql(
        "select count(*) as loaded, count(distinct product_url) as unique_keys, count(*) - count(distinct product_url) as duplicates "
        "from latest where source <> 'trend' and product_url <> ''",
        "listing", extra=LATEST,
    ),
)
def dup_count(spark, folder):
    return listing.dup_count(listing.latest_batch(view(spark, folder, "listing")), "product_url")


# --- ranks and duplicates -----------------------------------------------------------------------

PLACE = "coalesce(try_cast(trim(position) as int), 999)"


@query("page_order", check_sql(f"select listing_id, {PLACE} as place from v_listing", "listing"))
def page_order(spark, folder):
    return view(spark, folder, "listing").select("listing_id", listing.page_order("position").alias("place"))


FIRST = (
    f"firsts as (select * from (select *, row_number() over (partition by source, batch_id, product_url order by page_number, {PLACE}, listing_id) "
    "as rn from v_listing where product_url <> '') where rn = 1)"
)


def _firsts(spark, folder):
    rows = listing.valid_keys(view(spark, folder, "listing"), "product_url").withColumn("_place", listing.page_order("position"))
    return listing.dedupe_first(rows, ["source", "batch_id", "product_url"], ["page_number", "_place", "listing_id"])


@query("dedupe_first", check_sql("select listing_id, source, batch_id, product_url from firsts", "listing", extra=FIRST))
def dedupe_first(spark, folder):
    return _firsts(spark, folder).select("listing_id", "source", "batch_id", "product_url")


# Rows kept per batch of a feed.
FEED_CAPS = {"main": 300, "bsr": 100}


@query(
    "assign_rank",
    check_sql(
        "select listing_id, source, batch_id, cast(rk as int) as assigned_rank from (select *, row_number() over (partition by source, batch_id "
        f"order by page_number, {PLACE}, listing_id) as rk from firsts where source in ('main', 'bsr')) "
        "where rk <= case source when 'main' then 300 else 100 end",
        "listing", extra=FIRST,
    ),
)
def assign_rank(spark, folder):
    # One pass per feed: a constant cap lets the plan cut rows before the shuffle.
    ranked = [
        listing.assign_rank(
            _firsts(spark, folder).where(F.col("source") == feed), ["source", "batch_id"], ["page_number", "_place", "listing_id"], cap
        )
        for feed, cap in FEED_CAPS.items()
    ]
    return listing.union_feeds(*ranked).select("listing_id", "source", "batch_id", "assigned_rank")


@query(
    "assign_rank_all",
    check_sql(
        "select listing_id, source, batch_id, cast(row_number() over (partition by source, batch_id "
        f"order by page_number, {PLACE}, listing_id) as int) as assigned_rank from firsts",
        "listing", extra=FIRST,
    ),
)
def assign_rank_all(spark, folder):
    ranked = listing.assign_rank(_firsts(spark, folder), ["source", "batch_id"], ["page_number", "_place", "listing_id"])
    return ranked.select("listing_id", "source", "batch_id", "assigned_rank")


@query(
    "number_null_groups",
    check_sql(
        "select listing_id, promotion_type, row_number() over (partition by promotion_type order by rank nulls last, listing_id) as number from v_listing",
        "listing",
    ),
)
def number_null_groups(spark, folder):
    """Most rows have no promotion: NULL is a group of its own."""
    rows = view(spark, folder, "listing").select("listing_id", "promotion_type", "rank")
    return listing.number_rows(rows, ["promotion_type"], ["rank", "listing_id"], "number").drop("rank")


@query(
    "section_rank",
    check_sql(
        "select listing_id, batch_id, promotion_type, cast(rk as int) as promotion_rank from (select *, row_number() over (partition by batch_id, "
        "promotion_type order by rank, listing_id) as rk from v_listing where source = 'promotion') where rk <= 6",
        "listing",
    ),
)
def section_rank(spark, folder):
    rows = view(spark, folder, "listing").where("source = 'promotion'")
    ranked = listing.section_rank(rows, ["batch_id", "promotion_type"], ["rank", "listing_id"], 6)
    return ranked.select("listing_id", "batch_id", "promotion_type", "promotion_rank")


@query(
    "section_rank_all",
    check_sql(
        "select listing_id, batch_id, promotion_type, cast(row_number() over (partition by batch_id, promotion_type order by rank nulls last, listing_id) as int) "
        "as promotion_rank from v_listing where source = 'promotion'",
        "listing",
    ),
)
def section_rank_all(spark, folder):
    rows = view(spark, folder, "listing").where("source = 'promotion'")
    ranked = listing.section_rank(rows, ["batch_id", "promotion_type"], ["rank", "listing_id"])
    return ranked.select("listing_id", "batch_id", "promotion_type", "promotion_rank")


@query(
    "next_rank",
    check_sql("select batch_id, cast(coalesce(max(rank), 0) + 1 as bigint) as next_rank from v_listing where source = 'main' group by batch_id", "listing"),
)
def next_rank(spark, folder):
    return listing.next_rank(view(spark, folder, "listing").where("source = 'main'"), by=["batch_id"])


def _continued(offset: str) -> str:
    return check_sql(
        "select listing_id, batch_id, cast(row_number() over (partition by batch_id order by page_number, rank, listing_id) + "
        f"coalesce({offset}, 0) as bigint) as continued_rank from v_listing s where source = 'bsr'",
        "listing",
    )


def _continue(spark, folder, all_batches):
    rows = view(spark, folder, "listing")
    ranked = listing.continue_rank(
        rows.where("source = 'main'"), rows.where("source = 'bsr'"), ["batch_id"], ["page_number", "rank", "listing_id"], all_batches
    )
    return ranked.select("listing_id", "batch_id", "continued_rank")


@query("continue_rank", _continued("(select max(rank) from v_listing m where m.source = 'main' and m.batch_id = s.batch_id)"))
def continue_rank(spark, folder):
    return _continue(spark, folder, False)


@query("continue_rank_all", _continued("(select max(rank) from v_listing m where m.source = 'main')"))
def continue_rank_all(spark, folder):
    return _continue(spark, folder, True)


_NULL_GROUPS = "select *, case when page_number % 4 = 1 then null else page_number end as part from v_listing"


@query(
    "continue_rank_null_groups",
    check_sql(
        "select listing_id, part, cast(row_number() over (partition by part order by rank nulls last, listing_id) + coalesce((select max(rank) from g m where m.source = 'main' and m.part is not distinct from s.part), 0) "
        "as bigint) as continued_rank from g s where source = 'bsr'",
        "listing", extra=f"g as ({_NULL_GROUPS})",
    ),
)
def continue_rank_null_groups(spark, folder):
    """The group of NULL goes on after its own largest rank."""
    rows = view(spark, folder, "listing").withColumn("part", F.expr("case when page_number % 4 = 1 then null else page_number end"))
    ranked = listing.continue_rank(rows.where("source = 'main'"), rows.where("source = 'bsr'"), ["part"], ["rank", "listing_id"])
    return ranked.select("listing_id", "part", "continued_rank")


def _review_sql(prefix: str, separator: str) -> str:
    return check_sql(
        f"select product, count(*) as reviews, string_agg({prefix} trim(text, ' '), '{separator}' order by rn) as review_text from (select *, row_number() over "
        "(partition by product order by ordinal) as rn from v_reviews where length(trim(text, ' ')) > 10) where rn <= 20 group by product",
        "reviews",
    )


@query("top_reviews", _review_sql("rn || '-' ||", ", "))
def top_reviews(spark, folder):
    return listing.top_reviews(view(spark, folder, "reviews"), "product", "text", ["ordinal"], 20, 11)


@query("top_reviews_labelled", _review_sql("'review' || rn || '-' ||", ", "))
def top_reviews_labelled(spark, folder):
    return listing.top_reviews(view(spark, folder, "reviews"), "product", "text", ["ordinal"], 20, 11, style="labelled")


@query("top_reviews_bar", _review_sql("", " | "))
def top_reviews_bar(spark, folder):
    return listing.top_reviews(view(spark, folder, "reviews"), "product", "text", ["ordinal"], 20, 11, style="bar")


@query(
    "top_reviews_any_length",
    check_sql(
        "select product, count(*) as reviews, string_agg(rn || '-' || trim(text, ' '), ', ' order by rn) as review_text from (select *, row_number() over "
        "(partition by product order by ordinal) as rn from v_reviews where text is not null) where rn <= 20 group by product",
        "reviews",
    ),
)
def top_reviews_any_length(spark, folder):
    """For the shop without a rule on the length of reviews."""
    return listing.top_reviews(view(spark, folder, "reviews"), "product", "text", ["ordinal"], 20)


# --- audits -------------------------------------------------------------------------------------


@query(
    "duplicate_trace",
    check_sql(
        "select code, first_page, first_url, first_name, page_number as duplicate_page, place as duplicate_position, product_url as duplicate_url, "
        "retailer_sku_name as duplicate_name, retailer_sku_name = first_name as same_name, page_number - first_page as pages_apart from t "
        "where place_key > first_key order by duplicate_page, duplicate_position, code limit 100",
        "raw_data",
        extra="r as (select *, id as place, page_number * cast(1000000000 as bigint) + id as place_key from v_raw_data where trim(code) <> '' and "
              "trim(retailer_sku_name) <> ''), t as (select *, first_value(page_number) over w as first_page, first_value(product_url) over w as first_url, "
              "first_value(retailer_sku_name) over w as first_name, first_value(place_key) over w as first_key from r window w as "
              "(partition by code order by place_key))",
    ),
)
def duplicate_trace(spark, folder):
    return listing.duplicate_trace(
        view(spark, folder, "raw_data"), "code", "retailer_sku_name", "page_number", "product_url", "id", 100
    )


@query(
    "page_mismatch",
    check_sql(
        "select mall_name, page_number, first_index, cast((page_number - 1) * 16 + 1 as bigint) as expected_min, cast(page_number * 16 as bigint) "
        "as expected_max from (select mall_name, page_number, arg_min(sr, position * cast(1000000000 as bigint) + id) as first_index from v_raw_data group by all) "
        "where first_index not between (page_number - 1) * 16 + 1 and page_number * 16",
        "raw_data",
    ),
)
def page_mismatch(spark, folder):
    rows = view(spark, folder, "raw_data").withColumn("index", F.regexp_extract("product_url", r"sr=8-(\d+)", 1).try_cast("int"))
    return listing.page_mismatch(rows, ["mall_name"], "page_number", ["position", "id"], "index")


@query(
    "low_yield",
    check_sql(
        "select source, batch_id, page_number, count(*) as collected from v_listing where page_number <= 10 group by all having count(*) < 16", "listing"
    ),
)
def low_yield(spark, folder):
    return listing.low_yield(view(spark, folder, "listing"), ["source", "batch_id"], "page_number", first_pages=10)


@query(
    "low_yield_all",
    check_sql("select source, batch_id, page_number, count(*) as collected from v_listing group by all having count(*) < 16", "listing"),
)
def low_yield_all(spark, folder):
    return listing.low_yield(view(spark, folder, "listing"), ["source", "batch_id"], "page_number")


@query("rows_per_page", check_sql("select page_number, count(*) as collected from v_raw_data group by page_number", "raw_data"))
def rows_per_page(spark, folder):
    return listing.rows_per_page(view(spark, folder, "raw_data"))


@query(
    "duplicate_report",
    check_sql(
        "select r.retailer_sku_name, page_number, rows_on_page, page_count from (select retailer_sku_name, page_number, count(*) as rows_on_page "
        "from v_raw_data group by all) r join (select retailer_sku_name, count(*) as page_count from v_raw_data group by all having count(*) > 1 "
        "order by page_count desc, retailer_sku_name nulls first limit 20) t on t.retailer_sku_name is not distinct from r.retailer_sku_name",
        "raw_data",
    ),
)
def duplicate_report(spark, folder):
    return listing.duplicate_report(view(spark, folder, "raw_data"), "retailer_sku_name", "page_number", 20)


@query(
    "duplicate_pages",
    check_sql(
        "select r.retailer_sku_name, page_count, pages from (select retailer_sku_name, count(*) as page_count, string_agg(cast(page_number as varchar), ', ' order by page_number) as pages from v_raw_data "
        "group by all having count(*) > 1 order by page_count desc, retailer_sku_name nulls first limit 20) r",
        "raw_data",
    ),
)
def duplicate_pages(spark, folder):
    """The report with each name's pages in order as text."""
    found = listing.duplicate_report(view(spark, folder, "raw_data"), "retailer_sku_name", "page_number", 20)
    return listing.pack_pages(found, "retailer_sku_name", "page_number").select("retailer_sku_name", "page_count", "pages")


@query(
    "coverage",
    check_sql(
        "select page_number, count(*) as collected, cast(16 as bigint) as expected, 16 - count(*) as missing, case when count(*) = 16 then 'OK' "
        "else 'Missing ' || (16 - count(*)) end as status from v_raw_data group by page_number",
        "raw_data",
    ),
)
def coverage(spark, folder):
    return listing.coverage(view(spark, folder, "raw_data"))


@query(
    "coverage_total",
    check_sql(
        "select count(distinct page_number) as pages, least(300, count(distinct page_number) * 16) as expected, count(*) as actual, "
        "least(300, count(distinct page_number) * 16) - count(*) as difference from v_raw_data",
        "raw_data",
    ),
)
def coverage_total(spark, folder):
    return listing.coverage_total(view(spark, folder, "raw_data"), cap=300)


@query(
    "coverage_total_all",
    check_sql(
        "select count(distinct page_number) as pages, count(distinct page_number) * 16 as expected, count(*) as actual, "
        "count(distinct page_number) * 16 - count(*) as difference from v_raw_data",
        "raw_data",
    ),
)
def coverage_total_all(spark, folder):
    return listing.coverage_total(view(spark, folder, "raw_data"))


@query(
    "missing_pages",
    check_sql(
        "select distinct p_partkey as page_number from part where p_size % 7 <> 0 and p_partkey not in (select page_number from v_raw_data)", "raw_data"
    ),
)
def missing_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/part.parquet").selectExpr("p_partkey as page_number", "p_size % 7 <> 0 as is_active")
    rows = view(spark, folder, "raw_data").withColumn("page_number", F.col("page_number").cast("bigint"))
    return dml.missing_pages(pages, rows)


# --- filters ------------------------------------------------------------------------------------

MARKS = (
    "case event_id % 11 when 0 then 'x loom-desktop-top' when 1 then 'sb-themed' when 2 then 'multi-brand loom-desktop' when 3 then "
    "'FEATURED_ASINS_LIST-1' else 'MAIN-SEARCH' end"
)
COMPONENTS = (
    "case when event_id % 13 = 0 then 's-messaging-widget' else 's-search-result' end",
    "case when event_id % 17 = 0 then 'x-VideoLandscapeCarouselWidget-2' else '' end",
)


@query(
    "exclude_reason",
    f"with t as (select event_id, {MARKS} as w, {COMPONENTS[0]} as t, {COMPONENTS[1]} as i from events) select event_id, case when w like '%loom-desktop%' "
    "then 'loom-desktop' when w like '%sb-themed%' then 'sb-themed' when w like '%multi-brand%' then 'multi-brand' when w like '%FEATURED_ASINS_LIST%' then "
    "'FEATURED_ASINS_LIST' when t = 's-messaging-widget' then t when i like '%VideoLandscapeCarouselWidget%' then 'VideoLandscapeCarouselWidget' end as reason from t",
)
def exclude_reason(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_id", f"{MARKS} as w", f"{COMPONENTS[0]} as t", f"{COMPONENTS[1]} as i")
    return rows.select("event_id", listing.exclude_reason("w", "t", "i").alias("reason"))


TITLES = (
    "case p_size % 6 when 0 then p_name || ' on Prime VIDEO' when 1 then p_name || ' (paperback)' when 2 then 'Audio cd ' || p_name "
    "when 3 then null else p_name end"
)


@query(
    "off_category",
    f"with t as (select p_partkey, {TITLES} as t from part) select p_partkey, case when lower(t) like '%prime video%' then 'Prime Video' when "
    "regexp_matches(lower(t), 'paperback|kindle|audible|hardcover|audio cd|audiobook') then 'Book' end as reason from t",
)
def off_category(spark, folder):
    rows = spark.read.parquet(f"{folder}/part.parquet").selectExpr("p_partkey", f"{TITLES} as t")
    return rows.select("p_partkey", listing.off_category("t").alias("reason"))


@query(
    "require_fields",
    check_sql(
        "select count(*) filter (retailer_sku_name <> '' and product_url <> '') as kept, count(*) filter (not coalesce(retailer_sku_name <> '' and "
        "product_url <> '', false)) as dropped from v_raw_data",
        "raw_data",
    ),
)
def require_fields(spark, folder):
    return listing.dropped_by_require(view(spark, folder, "raw_data"), ["retailer_sku_name", "product_url"])


@query("require_rows", check_sql("select id from v_raw_data where retailer_sku_name <> ''", "raw_data"))
def require_rows(spark, folder):
    return listing.require(view(spark, folder, "raw_data"), ["retailer_sku_name"]).select("id")


@query("valid_keys", check_sql("select listing_id, product_url from v_listing where product_url is not null and product_url <> ''", "listing"))
def valid_keys(spark, folder):
    return listing.valid_keys(view(spark, folder, "listing"), "product_url").select("listing_id", "product_url")


@query(
    "outcome",
    check_sql(
        "select attempt_id, case when retailprice is null and title is null then 'no price and title' when retailprice is null then 'no price' else 'ok' end "
        "as outcome from v_log",
        "log",
    ),
)
def outcome_query(spark, folder):
    return view(spark, folder, "log").select("attempt_id", outcome("retailprice", "title").alias("outcome"))


SELLER = ("case event_id % 3 when 0 then ' ' when 1 then 'Amazon' end", "case event_id % 5 when 0 then '' when 1 then 'Shop' end")


@query(
    "null_if_no_seller",
    f"with t as (select event_id, cast(value as decimal(12,2)) as p, {SELLER[0]} as a, {SELLER[1]} as b from events) select event_id, "
    "case when coalesce(trim(a), '') <> '' or coalesce(trim(b), '') <> '' then p end as price from t",
)
def null_if_no_seller_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr(
        "event_id", "cast(value as decimal(12,2)) as p", f"{SELLER[0]} as a", f"{SELLER[1]} as b"
    )
    return rows.select("event_id", null_if_no_seller("p", "a", "b").alias("price"))


@query(
    "like_filters",
    "select page_id, url from pages where url not like 'https://%' and html ilike '%<H1>%the%'",
)
def like_filters(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet")
    return rows.where(~F.col("url").like("https://%") & F.col("html").ilike("%<H1>%the%")).select("page_id", "url")


CHANNEL = "case event_id % 5 when 0 then 'Best Buy' when 1 then 'Amazon' when 2 then 'Walmart' when 3 then 'eShop' end"


@query(
    "channel_domain",
    f"with t as (select event_id, {CHANNEL} as raw from events), n as (select event_id, case when raw = 'Best Buy' then 'Bestbuy' else raw end as channel "
    "from t) select event_id, channel, channel is null or channel in ('Amazon', 'Bestbuy', 'Walmart') as valid from n",
)
def channel_domain(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_id", f"{CHANNEL} as raw")
    named = rows.select("event_id", dml.norm_channel("raw").alias("channel"))
    return named.withColumn("valid", dml.valid_in("channel", dml.CHANNEL_DOMAIN))


@query(
    "crawl_range",
    check_sql("select id, crawl_strdatetime from v_unified where crawl_strdatetime between '20240105000000' and '20240112235959'", "unified"),
)
def crawl_range(spark, folder):
    rows = view(spark, folder, "unified").select("id", "crawl_strdatetime")
    return rows.where(F.col("crawl_strdatetime").between("20240105000000", "20240112235959"))


@query("distinct_projection", check_sql("select distinct source, product_url, sku_status from v_listing", "listing"))
def distinct_projection(spark, folder):
    return view(spark, folder, "listing").select("source", "product_url", "sku_status").distinct()


@query(
    "union_feeds",
    check_sql(
        "select source, product_url, batch_id, case when source = 'promotion' then promotion_type end as promotion_type from v_listing where source <> 'trend'",
        "listing",
    ),
)
def union_feeds(spark, folder):
    rows = view(spark, folder, "listing").select("source", "product_url", "batch_id", "promotion_type")
    main, bsr = (rows.where(F.col("source") == f).drop("promotion_type") for f in ("main", "bsr"))
    return listing.union_feeds(main, bsr, rows.where("source = 'promotion'"))


STORED = "select p_type as element_type, p_brand as selector, min(p_partkey) as priority from part group by all"
DEFAULT = "select p_type as element_type, 'Brand#' || (p_size % 30) as selector, min(p_size) as priority from part group by all"


def _selectors(db_first: bool) -> str:
    a, b = (0, 1) if db_first else (1, 0)
    return (
        f"with s as (select *, {a} as l from ({STORED}) union all select *, {b} as l from ({DEFAULT})), d as (select *, row_number() over "
        "(partition by element_type, selector order by l, priority) as rn from s) select element_type, selector, cast(row_number() over "
        "(partition by element_type order by l, priority, selector) as int) as position from d where rn = 1"
    )


def _merge_selectors(spark, folder, db_first):
    part = spark.read.parquet(f"{folder}/part.parquet")
    stored = part.groupBy(F.col("p_type").alias("element_type"), F.col("p_brand").alias("selector")).agg(F.min("p_partkey").alias("priority"))
    default = part.groupBy(
        F.col("p_type").alias("element_type"), F.concat(F.lit("Brand#"), (F.col("p_size") % 30).cast("string")).alias("selector")
    ).agg(F.min(F.col("p_size").cast("bigint")).alias("priority"))
    return listing.merge_selectors(stored, default, ["element_type"], "selector", db_first)


@query("merge_selectors", _selectors(True))
def merge_selectors(spark, folder):
    return _merge_selectors(spark, folder, True)


@query("merge_selectors_default_first", _selectors(False))
def merge_selectors_default_first(spark, folder):
    return _merge_selectors(spark, folder, False)
