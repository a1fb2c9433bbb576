"""Country price tracker, statistics and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.money import outcome
from shelfwise.operators import report, tracker
from shelfwise.plans.registry import query
from shelfwise.plans.views import check_sql, view
from shelfwise.schema import describe_columns

NOW = "2024-01-30 12:00:00"
LAST_SALE = "2001-01-01 00:00:00"


def _log(spark, folder):
    return view(spark, folder, "log").withColumn("crawl_datetime", F.col("ts").cast("timestamp"))


def _sales(spark, folder):
    return view(spark, folder, "sales").withColumn("crawl_datetime", F.col("crawl_datetime").cast("timestamp"))


TARGET_COLUMNS = ["url", "country", "mall_name", "brand", "capacity"]


@query(
    "crawl_targets",
    check_sql(f"select {', '.join(TARGET_COLUMNS)} from v_targets where country = 'nl' and mall_name = 'coolblue' and is_active", "targets"),
)
def crawl_targets(spark, folder):
    return tracker.crawl_targets(view(spark, folder, "targets"), "nl", "coolblue").select(*TARGET_COLUMNS)


@query(
    "active_pages",
    "select page_id as page_number, url from pages where url like '%?page=%' order by page_id",
)
def active_pages(spark, folder):
    pages = view(spark, folder, "pages").selectExpr(
        "page_id as page_number", "url", "'shop' as mall_name", "url like '%?page=%' as is_active"
    )
    return tracker.active_pages(pages, "shop")


FAILED = f"failed as (select url, count(*) as fail_count from v_log where retailprice is null and ts >= timestamp '{NOW}' - interval 24 hour group by url)"


@query("failed_counts", check_sql("select * from failed", "log", extra=FAILED))
def failed_counts(spark, folder):
    return tracker.failed_counts(_log(spark, folder), NOW)


@query(
    "retry_targets",
    check_sql(
        "select distinct t.url, t.country, t.brand, coalesce(f.fail_count, 0) as fail_count from v_targets t left join failed f using (url) "
        "where is_active and coalesce(f.fail_count, 0) < 2",
        "targets", "log", extra=FAILED,
    ),
)
def retry_targets(spark, folder):
    targets = view(spark, folder, "targets").where("is_active").select("url", "country", "brand")
    return tracker.retry_targets(targets, _log(spark, folder), NOW, max_fail=2)


@query(
    "retry_targets_by_country",
    check_sql(
        "select distinct t.url, t.country, t.brand, coalesce(f.fail_count, 0) as fail_count from v_targets t left join (select url, case attempt_id % 3 when 0 then 'nl' when 1 then 'it' else 'de' end as country, "
        f"count(*) as fail_count from v_log where retailprice is null and ts >= timestamp '{NOW}' - interval 240 hour group by all) f on f.url = t.url and f.country = t.country "
        "where is_active and coalesce(f.fail_count, 0) < 2",
        "targets", "log",
    ),
)
def retry_targets_by_country(spark, folder):
    """Failures count for their own country's target only."""
    targets = view(spark, folder, "targets").where("is_active").select("url", "country", "brand")
    log = _log(spark, folder).withColumn("country", F.expr("case attempt_id % 3 when 0 then 'nl' when 1 then 'it' else 'de' end"))
    return tracker.retry_targets(targets, log, NOW, hours=240, max_fail=2, by=("url", "country"))


OBSERVED = (
    "observed as (select * from (select *, row_number() over (partition by url order by ts desc, attempt_id desc) as rn from v_log) where rn = 1)"
)


def _observed(spark, folder):
    rows = _log(spark, folder)
    last = rows.groupBy("url").agg(
        F.max_by(F.struct("retailprice", "title", "crawl_datetime"), F.struct("ts", "attempt_id")).alias("_o")
    )
    return last.select("url", "_o.*").selectExpr(
        "*", "case when title is null then null else 'Amazon' end as ships_from", "cast(null as string) as sold_by", "cast(null as string) as imageurl"
    )


def _facts(spark, folder):
    return tracker.price_rows(view(spark, folder, "targets"), _observed(spark, folder))


@query(
    "price_rows",
    check_sql(
        "select t.retailerid, t.country as country_code, case when o.title is not null then 'Amazon' end as ships_from, coalesce(t.channel, 'Online') as channel, "
        "t.retailersku, t.brand, coalesce(nullif(t.brand_eng, ''), t.brand) as brand_eng, t.form_factor, t.seg_lv1 as segment_lv1, t.seg_lv2 as segment_lv2, "
        "t.seg_lv3 as segment_lv3, t.capacity, t.item, o.retailprice, cast(null as varchar) as sold_by, cast(null as varchar) as imageurl, t.url as producturl, "
        "strftime(o.ts, '%Y%m%d%H%M%S') || substr(strftime(o.ts, '%f'), 1, 4) as crawl_strdatetime, o.title, coalesce(t.vat, 'o') as vat "
        "from v_targets t left join observed o using (url)",
        "targets", "log", extra=OBSERVED,
    ),
)
def price_rows(spark, folder):
    return _facts(spark, folder).drop("crawl_datetime")


@query(
    "attempt_log",
    check_sql(
        "select t.country as country_code, t.url, case when retailprice is not null then 'success' else 'failed' end as status, case when retailprice is null then "
        "'Price not found' end as error_message, retailprice from v_targets t left join observed o using (url)",
        "targets", "log", extra=OBSERVED,
    ),
)
def attempt_log(spark, folder):
    return tracker.attempt_log(_facts(spark, folder)).drop("crawl_datetime")


# --- statistics ---------------------------------------------------------------------------------

MEAN = "cast(sum(retailprice) as double) / count(retailprice)"
STATS = (
    f"{MEAN} as mean_price, min(retailprice) as min_price, max(retailprice) as max_price, count(retailprice) as priced, "
    "cast(median(cast(retailprice as double)) as decimal(14,3)) as median_price"
)


@query("price_stats", check_sql(f"select {STATS} from v_sales", "sales"))
def price_stats(spark, folder):
    return report.price_stats(_sales(spark, folder), "retailprice", [])


@query("price_stats_by_brand", check_sql(f"select brand, {STATS} from v_sales group by brand", "sales"))
def price_stats_by_brand(spark, folder):
    return report.price_stats(_sales(spark, folder), "retailprice", ["brand"])


@query(
    "price_stats_null_groups",
    check_sql(f"select nullif(brand, 'Brand#11') as brand, {STATS} from v_sales group by 1", "sales"),
)
def price_stats_null_groups(spark, folder):
    """Rows without a brand are a group of their own."""
    sales = _sales(spark, folder).withColumn("brand", F.nullif("brand", F.lit("Brand#11")))
    return report.price_stats(sales, "retailprice", ["brand"])


@query(
    "daily_history",
    check_sql(
        "select cast(crawl_datetime as date) as date, count(*) as total_count, count(retailprice) as with_price, count(distinct brand) as brands, "
        f"count(distinct item) as items from v_sales where crawl_datetime >= timestamp '{LAST_SALE}' - interval 365 day group by 1",
        "sales",
    ),
)
def daily_history(spark, folder):
    return report.daily_history(_sales(spark, folder), LAST_SALE, 365)


@query(
    "brand_success",
    check_sql(
        "select brand, count(*) as total, count(retailprice) as success, round(count(retailprice) * 100 / count(*), 1) as success_rate from v_sales group by brand", "sales"
    ),
)
def brand_success(spark, folder):
    return report.brand_success(_sales(spark, folder))


@query(
    "capacity_stats",
    check_sql(f"select capacity, {MEAN} as mean_price, count(retailprice) as priced from v_sales where retailprice is not null group by capacity", "sales"),
)
def capacity_stats(spark, folder):
    return report.capacity_stats(_sales(spark, folder))


@query(
    "brand_counts",
    check_sql("select brand, count(*) as priced from v_sales where retailprice is not null group by brand order by priced desc, brand", "sales"),
)
def brand_counts(spark, folder):
    return report.brand_counts(_sales(spark, folder))


@query("success_rate", check_sql("select coalesce(count(retailprice) * 100 / nullif(count(*), 0), 0) as success_rate from v_sales", "sales"))
def success_rate(spark, folder):
    return report.success_rate(_sales(spark, folder))


EXTRA = {"Crawl Date": "2024-01-30 12:00:00", "Country Code": "NL", "Mall Name": "Coolblue"}
SUMMARY = (
    "select 'Total Products' as metric, cast(count(*) as varchar) as value from v_sales union all select 'Products with Price', cast(count(retailprice) as varchar) "
    "from v_sales union all select 'Products without Price', cast(count(*) - count(retailprice) as varchar) from v_sales union all select 'Success Rate (%)', "
    "cast(round(count(retailprice) * 100 / count(*), 2) as varchar) from v_sales"
)


@query("summary", check_sql(SUMMARY + "".join(f" union all select '{m}', '{v}'" for m, v in EXTRA.items()), "sales"))
def summary(spark, folder):
    return report.summary(_sales(spark, folder), extra=EXTRA)


@query(
    "report_with_prices",
    check_sql("select orderkey, linenumber, partkey, retailprice from v_sales where retailprice is not null", "sales"),
)
def report_with_prices(spark, folder):
    frames = report.report_frames(_sales(spark, folder))
    return frames["With_Prices"].select("orderkey", "linenumber", "partkey", "retailprice")


@query("abnormal_prices", check_sql("select item, retailprice from v_sales where retailprice < 10 or retailprice > 10000", "sales"))
def abnormal_prices(spark, folder):
    return report.abnormal_prices(_sales(spark, folder)).select("item", "retailprice")


PROFILED = ["product_url", "retailer_sku_name", "final_sku_price", "original_sku_price", "offer", "sku_status"]


@query(
    "null_profile",
    check_sql(
        " union all ".join(
            f"select '{c}' as column_name, count(*) as total, count({c}) as non_null, count(*) - count({c}) as nulls from v_listing" for c in PROFILED
        ),
        "listing",
    ),
)
def null_profile(spark, folder):
    return report.null_profile(view(spark, folder, "listing"), PROFILED)


@query(
    "today_count",
    check_sql("select count(*) as today_count from v_log where cast(ts as date) = date '2024-01-15'", "log"),
)
def today_count(spark, folder):
    return report.today_count(_log(spark, folder), "2024-01-15")


TABLES = ["listing", "unified", "targets", "sales"]


@query(
    "table_counts",
    check_sql(" union all ".join(f"select '{t}' as table_name, count(*) as rows from v_{t}" for t in TABLES), *TABLES),
)
def table_counts(spark, folder):
    return report.table_counts(spark, {t: view(spark, folder, t) for t in TABLES})


@query(
    "reconcile",
    check_sql(
        "select account_name, count(*) as read_rows, count(*) filter (final_sku_price is not null) as inserted_rows, count(*) filter (final_sku_price is null) as errors "
        "from v_unified group by account_name",
        "unified",
    ),
)
def reconcile(spark, folder):
    rows = view(spark, folder, "unified")
    sources = {a: rows.where(F.col("account_name") == a) for a in ("Amazon", "Bestbuy", "Walmart")}
    return report.reconcile(sources, rows.where("final_sku_price is not null"))


@query(
    "latest_rows",
    "select doc_id, source, n_chars, length(text) as text_length from documents order by doc_id desc limit 10",
)
def latest_rows(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    return report.latest(rows, "doc_id", 10, "text").select("doc_id", "source", "n_chars", F.col("text_length").cast("bigint").alias("text_length"))


@query(
    "head_rows",
    check_sql("select id, page_number, retailer_sku_name from v_raw_data order by page_number, id limit 10", "raw_data"),
)
def head_rows(spark, folder):
    return report.head_by(view(spark, folder, "raw_data").select("id", "page_number", "retailer_sku_name"), ["page_number", "id"], 10)


@query(
    "sample_failures",
    check_sql(
        "select attempt_id, outcome, (select count(*) from v_log where retailprice is null) as total_failures from (select attempt_id, case when title is null then "
        "'no price and title' else 'no price' end as outcome from v_log where retailprice is null) order by attempt_id limit 5",
        "log",
    ),
)
def sample_failures(spark, folder):
    rows = view(spark, folder, "log").select("attempt_id", outcome("retailprice", "title").alias("outcome"))
    return report.sample_failures(rows, ["attempt_id"], 5)


DESCRIBED = {
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "pages": ["page_id", "url", "html"],
}
TYPE_NAME = (
    "case typeof(any_value({})) when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'VARCHAR' then 'string' "
    "when 'TIMESTAMP' then 'timestamp_ntz' end"
)


@query(
    "describe_tables",
    " union all ".join(
        f"select '{t}' as table_name, {i} as position, '{c}' as column_name, {TYPE_NAME.format(c)} as type, true as nullable, count(*) as rows from {t}"
        for t, columns in DESCRIBED.items()
        for i, c in enumerate(columns, 1)
    ),
)
def describe_tables(spark, folder):
    tables = {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in DESCRIBED}
    return describe_columns(spark, tables).join(report.table_counts(spark, tables), "table_name")
