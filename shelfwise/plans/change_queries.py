"""Inserts, updates, lookups, schema changes, quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.clock import strdatetime
from shelfwise.operators import dml, listing, quality
from shelfwise.plans.registry import query
from shelfwise.plans.views import check_sql, view
from shelfwise.schema import UNIFIED_COLUMNS, Evolution, align, evolve, unify
from shelfwise.sources.readers import split_page_urls
from shelfwise.sources.sinks import restore

# Stored rows: the first batch of the feeds; incoming: all later ones.
HALF = "20240101_000000"
LATER = f"batch_id > '{HALF}'"
KEYS = ["source", "product_url"]


def _split(spark, folder):
    rows = view(spark, folder, "listing").where("product_url <> ''")
    rows = rows.select("source", "product_url", "batch_id", "rank", "listing_id", "offer", "sku_status")
    old = listing.dedupe_first(rows.where(f"batch_id <= '{HALF}'"), KEYS, ["batch_id", "rank", "listing_id"])
    return rows.where(LATER), old


OLD = (
    "old as (select source, product_url, batch_id, rank, listing_id, offer, sku_status from (select *, row_number() over (partition by source, product_url order by batch_id, "
    f"rank, listing_id) as rn from v_listing where product_url <> '' and batch_id <= '{HALF}') where rn = 1), "
    "fresh as (select source, product_url, batch_id, rank, listing_id, offer, sku_status from (select *, row_number() over (partition by source, product_url order by rank, "
    f"listing_id) as rn from v_listing where product_url <> '' and {LATER}) where rn = 1), "
    "added as (select * from fresh f where not exists (select 1 from old o where o.source = f.source and o.product_url = f.product_url))"
)
ORDER = ["rank", "listing_id"]


@query("new_only", check_sql("select listing_id from added", "listing", extra=OLD))
def new_only(spark, folder):
    incoming, old = _split(spark, folder)
    return dml.new_only(incoming, old, KEYS, ORDER).select("listing_id")


@query("insert_absent", check_sql("select * from old union all select * from added", "listing", extra=OLD))
def insert_absent(spark, folder):
    incoming, old = _split(spark, folder)
    return dml.insert_absent(incoming, old, KEYS, ORDER)


@query(
    "upsert",
    check_sql(
        "select coalesce(o.source, f.source) as source, coalesce(o.product_url, f.product_url) as product_url, coalesce(o.batch_id, f.batch_id) as batch_id, "
        "case when o.source is not null then o.rank else f.rank end as rank, coalesce(o.listing_id, f.listing_id) as listing_id, case when f.source is not null then f.offer else o.offer end as offer, "
        "case when f.source is not null then f.sku_status else o.sku_status end as sku_status from old o full outer join fresh f on o.source = f.source and "
        "o.product_url = f.product_url",
        "listing", extra=OLD,
    ),
)
def upsert(spark, folder):
    incoming, old = _split(spark, folder)
    return dml.upsert(incoming, old, KEYS, ["offer", "sku_status"], ORDER)


@query(
    "update_where",
    "select p_partkey, case when p_type = 'ECONOMY' and p_size = 11 then 'Fixed' else p_name end as p_name, case when p_type = 'ECONOMY' and p_size = 11 then 1 else p_size end as p_size from part",
)
def update_where(spark, folder):
    rows = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_name", "p_size", "p_type")
    chosen = (F.col("p_type") == "ECONOMY") & (F.col("p_size") == 11)
    out = dml.update_where(rows, chosen, {"p_name": F.lit("Fixed"), "p_size": F.lit(1)})
    return out.select("p_partkey", "p_name", "p_size")


@query("fill_default", check_sql("select listing_id, coalesce(sku_status, 'main') as sku_status, coalesce(offer, '0') as offer from v_listing", "listing"))
def fill_default(spark, folder):
    rows = view(spark, folder, "listing").select("listing_id", "sku_status", "offer")
    return dml.fill_default(rows, {"sku_status": "main", "offer": "0"})


@query(
    "lookup_latest",
    check_sql(
        "select l.listing_id, p.found from v_listing l left join (select retailer_sku_name, arg_max(item, id) as found from v_detail where item is not null group by 1) p "
        "using (retailer_sku_name)",
        "listing", "detail",
    ),
)
def lookup_latest(spark, folder):
    rows = view(spark, folder, "listing").select("listing_id", "retailer_sku_name")
    return dml.lookup_latest(rows, view(spark, folder, "detail"), "retailer_sku_name", "item", ["id"], "found").drop("retailer_sku_name")


@query(
    "fill_from_peers",
    check_sql(
        "select id, product_name, coalesce(item, found) as item from v_master left join (select product_name, arg_max(item, id) as found from v_master where item is not null "
        "group by 1) using (product_name)",
        "master",
    ),
)
def fill_from_peers(spark, folder):
    return dml.fill_from_peers(view(spark, folder, "master"), "product_name", "item", ["id"])


@query(
    "master_items",
    check_sql(
        "select listing_id, pos, retailer_sku_name as product_name, case when pos = 1 then 'current' else found end as item from (select *, event_pos as pos from (select listing_id, "
        "retailer_sku_name, listing_id % 4 + 1 as event_pos from v_listing)) left join (select retailer_sku_name, arg_max(item, crawl_strdatetime || item) as found from v_detail "
        "where item is not null and crawl_strdatetime is not null group by 1) using (retailer_sku_name)",
        "listing", "detail",
    ),
)
def master_items(spark, folder):
    products = view(spark, folder, "listing").selectExpr(
        "listing_id", "listing_id % 4 + 1 as pos", "retailer_sku_name as product_name", "'current' as current_item"
    )
    details = view(spark, folder, "detail").where("crawl_strdatetime is not null")
    return dml.master_items(products, details).select("listing_id", "pos", "product_name", "item")


@query(
    "detail_with_listing",
    check_sql(
        "select d.id, o.page_type, o.rank, coalesce(o.sku_status, d.status_badge) as sku_status from v_detail d left join (select product_url, source as page_type, rank, "
        "sku_status from (select *, row_number() over (partition by product_url order by case source when 'main' then 1 when 'bsr' then 2 else 3 end, rank, listing_id) as rn "
        "from v_listing where product_url <> '' and source <> 'trend') where rn = 1) o using (product_url)",
        "detail", "listing",
    ),
)
def detail_with_listing(spark, folder):
    feeds = view(spark, folder, "listing")
    merged = listing.merge_feeds(feeds, "product_url", ["rank", "sku_status"], order=("rank", "listing_id"))
    return dml.detail_with_listing(view(spark, folder, "detail"), merged, ["rank"]).select("id", "page_type", "rank", "sku_status")


# --- schema -------------------------------------------------------------------------------------

SHOPS = ["Amazon", "Bestbuy", "Walmart"]


def _aligned(spark, folder):
    rows = view(spark, folder, "detail")
    return unify(*[align(rows.where(F.col("account_name") == a), a, {"status_badge": "sku_status"}) for a in SHOPS])


@query(
    "align_unified",
    check_sql(
        "select " + ", ".join(
            {"sku_status": "status_badge as sku_status"}.get(c, c)
            if c in ("item", "account_name", "retailer_sku_name", "product_url", "final_sku_price", "original_sku_price", "sku_status", "crawl_strdatetime")
            else f"cast(null as {t}) as {c}"
            for c, t in UNIFIED_COLUMNS
        ) + " from v_detail",
        "detail",
    ),
)
def align_unified(spark, folder):
    # Crawl times are timestamps there; here they are written as the shops' tables have them.
    return _aligned(spark, folder).withColumn("crawl_strdatetime", strdatetime("crawl_strdatetime"))


@query(
    "evolve_schema",
    check_sql(
        "select item, id as detail_id, account_name as mall, cast(null as varchar) as page_type, cast(null as int) as trend_rank, cast(batch_id as varchar) as batch_id from v_detail",
        "detail",
    ),
)
def evolve_schema(spark, folder):
    change = Evolution(
        rename={"account_name": "mall", "absent": "still_absent", "id": "detail_id"},
        add={"page_type": "string", "trend_rank": "int", "item": "string"},
        cast={"batch_id": "string", "missing": "int"},
        drop=("product_url", "retailer_sku_name", "status_badge", "final_sku_price", "original_sku_price", "crawl_strdatetime", "absent"),
        order=("item", "detail_id"),
    )
    return evolve(view(spark, folder, "detail"), change)


@query(
    "restore_backup",
    check_sql("select id, account_name as channel, cast(null as int) as new_rank from v_detail", "detail"),
)
def restore_backup(spark, folder):
    return restore(view(spark, folder, "detail"), {"account_name": "channel"}, {"id": "bigint", "channel": "string", "new_rank": "int"})


@query(
    "split_page_urls",
    "select cast(page_id as int) as page_number, trim(url || ',x=1') as url from pages where page_id % 5 <> 2",
)
def split_page_urls_query(spark, folder):
    lines = spark.read.parquet(f"{folder}/pages.parquet").selectExpr(
        "case when page_id % 5 = 2 then 'page,' || url else ' ' || cast(page_id as string) || ', ' || url || ',x=1' end as value"
    )
    return split_page_urls(lines)


# --- quality ------------------------------------------------------------------------------------

CHECKED = {
    "item": "case event_id % 7 when 0 then null when 1 then ' ' when 2 then 'None' when 3 then '24 inch' when 4 then '55 inch Smart TV' else 'M' || cast(user_id as string) end",
    "final_sku_price": "case event_id % 8 when 0 then '' when 1 then 'none' when 2 then '599' when 3 then '$abc' when 4 then '$0' when 5 then '$60,000' else '$' || cast(cast(value as decimal(12,2)) as string) end",
    "original_sku_price": "case event_id % 3 when 0 then null when 1 then '12' else '$12' end",
    "savings": "case event_id % 9 when 0 then '5' when 1 then '$5' when 2 then '' end",
    "screen_size": "case event_id % 6 when 0 then '' when 1 then '55' when 2 then 'inch' when 3 then '19 Inch' when 4 then '101 inch' else '55 inch' end",
    "count_of_reviews": "case event_id % 5 when 0 then 'none' when 1 then '-4' when 2 then 'many' when 3 then '1,' || lpad(cast(user_id as string), 3, '0') end",
    "star_rating": "case event_id % 4 when 0 then '4.5' when 1 then '5.1' when 2 then 'good' end",
}
FOUND = [
    "select event_id, 'item' as field, item as value, case when item is null or trim(item) = '' or lower(item) = 'none' then 'NULL_VALUE' else 'FORMAT_ISSUE' end as issue_type, "
    "case when item is null or trim(item) = '' then 'Should have item value' when lower(item) = 'none' then 'Item should not be \"none\"' else 'Should include model name or \"TV\"' end as expected "
    "from q where event_id % 7 in (0, 1, 2, 3)",
    "select event_id, 'final_sku_price', final_sku_price, case event_id % 8 when 0 then 'NULL_VALUE' when 1 then 'NULL_VALUE' when 2 then 'FORMAT_ISSUE' when 3 then 'FORMAT_ISSUE' else 'OUTLIER' end, "
    "case event_id % 8 when 0 then 'Should have price value' when 1 then 'Price should not be \"none\"' when 2 then 'Should start with $' when 3 then 'Cannot parse price value' "
    "when 5 then 'Price seems unusually high (> $50,000)' else 'Price should be greater than $0' end from q where event_id % 8 <= 5 or final_sku_price in ('$0.00')",
    "select event_id, 'original_sku_price', original_sku_price, 'FORMAT_ISSUE', 'Should start with $' from q where event_id % 3 = 1",
    "select event_id, 'savings', savings, 'FORMAT_ISSUE', 'Should start with $' from q where event_id % 9 = 0",
    "select event_id, 'screen_size', screen_size, case event_id % 6 when 0 then 'NULL_VALUE' when 1 then 'FORMAT_ISSUE' when 2 then 'FORMAT_ISSUE' else 'OUTLIER' end, case event_id % 6 when 0 then 'Should have screen size' when 1 then 'Should include \"inch\"' when 2 then "
    "'Cannot extract size number' else 'Screen size seems unusual (expected 20-100 inch)' end from q where event_id % 6 <= 4",
    "select event_id, 'count_of_reviews', count_of_reviews, case event_id % 5 when 1 then 'OUTLIER' else 'FORMAT_ISSUE' end, case event_id % 5 when 1 then 'Count should not be negative' else 'Should be numeric' end from q where event_id % 5 in (1, 2)",
    "select event_id, 'star_rating', star_rating, case event_id % 4 when 1 then 'OUTLIER' else 'FORMAT_ISSUE' end, case event_id % 4 when 1 then 'Rating should be between 0 and 5' else 'Should be numeric (0-5)' end from q where event_id % 4 in (1, 2)",
]
QUALITY = f"with q as (select event_id, {', '.join(f'{e} as {c}' for c, e in CHECKED.items())} from events), i as ({' union all '.join(FOUND)}) "


def _issues(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_id", *[f"{e} as {c}" for c, e in CHECKED.items()])
    return quality.issues(rows, "detail", ["event_id"])


@query("issues", QUALITY + "select 'detail' as source, * from i")
def issues(spark, folder):
    return _issues(spark, folder)


@query("issue_summary", QUALITY + "select issue_type, count(*) as issues from i group by issue_type")
def issue_summary(spark, folder):
    return quality.issue_summary(_issues(spark, folder))


SAVED = (
    "'$' || cast(cast(value as decimal(12,2)) as string)", "'$' || cast(cast(value as decimal(12,2)) + cast(5 as decimal(12,2)) as string)",
    "case event_id % 3 when 0 then '$5.00' when 1 then '$4.00' end",
)


@query("savings_issues", "select event_id from events where event_id % 3 = 1")
def savings_issues(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_id", f"{SAVED[0]} as f", f"{SAVED[1]} as o", f"{SAVED[2]} as s")
    return quality.savings_issues(rows, "f", "o", "s").select("event_id")


@query(
    "duplicate_keys",
    check_sql("select mall_name, retailer_sku_name, count(*) as rows from v_raw_data group by 1, 2 having count(*) > 1", "raw_data"),
)
def duplicate_keys(spark, folder):
    return quality.duplicate_keys(view(spark, folder, "raw_data"), ["mall_name", "retailer_sku_name"])
