"""Sinks and streams: write the given tables, read back what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.clock import batch_id, strdatetime
from shelfwise.operators.listing import union_feeds
from shelfwise.plans.registry import query
from shelfwise.plans.views import check_sql, view
from shelfwise.schema import ACCOUNTS, align
from shelfwise.session import shared_dir
from shelfwise.sources import sinks
from shelfwise.sources.readers import read_page_urls, read_pages
from shelfwise.streaming import jobs

FACTS = ["url", "country", "brand", "capacity"]


@query("append_facts", check_sql(f"select {', '.join(FACTS)} from v_targets", "targets"))
def append_facts(spark, folder):
    rows = view(spark, folder, "targets").select(*FACTS)
    path = shared_dir(spark, "facts")
    for active in ("country in ('it', 'de', 'fr', 'es')", "country not in ('it', 'de', 'fr', 'es')"):
        sinks.append(rows.where(active), path, ["country"])
    return spark.read.parquet(path).select(*FACTS)


@query("append_once", check_sql("select distinct url, country from v_targets", "targets"))
def append_once(spark, folder):
    rows = view(spark, folder, "targets").select("url", "country")
    path = shared_dir(spark, "facts-keyed")
    sinks.append_new(rows.where("country < 'g'"), path, ["url"], ["country"])
    sinks.append_new(rows, path, ["url"], ["country"])
    return spark.read.parquet(path)


@query("export_csv", check_sql("select url, brand, item, cast(capacity as varchar) as capacity from v_targets where country = 'nl'", "targets"))
def export_csv(spark, folder):
    rows = view(spark, folder, "targets").where("country = 'nl'").select("url", "brand", "item", "capacity")
    path = sinks.export_csv(rows, shared_dir(spark, "csv"), "nl", "coolblue", "20240130120000")
    return spark.read.option("header", True).schema(rows.schema).csv(path)


@query(
    "export_json",
    check_sql(
        "select orderkey, linenumber, retailprice, 'nl' as country, '2024-01-30 12:00:00' as crawl_datetime, (select count(retailprice) from v_sales) as successful_crawls, "
        "(select count(*) from v_sales) as total_products from v_sales",
        "sales",
    ),
)
def export_json(spark, folder):
    """Every record as it was written, beside the figures of the metadata file."""
    rows = view(spark, folder, "sales").select("orderkey", "linenumber", "retailprice")
    results, info = sinks.export_json(rows, shared_dir(spark, "json"), {"country": "nl", "crawl_datetime": "2024-01-30 12:00:00"})
    meta = spark.read.schema("total_products bigint, successful_crawls bigint, country string, crawl_datetime string").json(info)
    return spark.read.schema(rows.schema).json(results).withColumns({c: meta.select(c).scalar() for c in meta.columns})


@query(
    "fanout",
    check_sql(
        "select 'raw' as kind, listing_id, source, product_url from v_listing where product_url <> '' union all select 'unique', listing_id, source, product_url from (select *, row_number() over "
        "(partition by source, product_url order by listing_id) as rn from v_listing where product_url <> '') where rn = 1",
        "listing",
    ),
)
def fanout(spark, folder):
    rows = view(spark, folder, "listing").where("product_url <> ''").select("listing_id", "source", "product_url")
    raw, unique = shared_dir(spark, "raw"), shared_dir(spark, "unique")
    sinks.fanout(rows, ["source", "product_url"], ["listing_id"], raw, unique)
    return union_feeds(
        *[spark.read.parquet(path).withColumn("kind", F.lit(kind)) for kind, path in (("raw", raw), ("unique", unique))]
    )


@query("snapshot", check_sql("select * from v_unified", "unified"))
def snapshot(spark, folder):
    path = sinks.snapshot(view(spark, folder, "unified"), shared_dir(spark, "backup"), "unified", "20240130")
    return spark.read.parquet(path)


@query("reload", "select page_id, upper(url) as url from pages")
def reload(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    path = shared_dir(spark, "reload")
    sinks.overwrite(rows, path)
    # The new content is made from the table that it replaces.
    sinks.overwrite(spark.read.parquet(path).select("page_id", F.upper("url").alias("url")), path)
    return spark.read.parquet(path)


@query(
    "dual_write",
    check_sql(
        "select account_name, product_url, final_sku_price, crawl_strdatetime, count(*) as detail_rows, count(*) as unified_rows from v_detail group by all", "detail"
    ),
)
def dual_write(spark, folder):
    """Rows of all shops in both tables, counted by what the tables share."""
    detail = view(spark, folder, "detail")
    detail_path, unified_path = shared_dir(spark, "detail"), shared_dir(spark, "unified")
    for account in ACCOUNTS:
        own = detail.where(F.col("account_name") == account)
        sinks.write_both(own, align(own, account), detail_path, unified_path)
    keys = ["account_name", "product_url", "final_sku_price", "crawl_strdatetime"]
    unified = spark.read.parquet(unified_path).withColumn("crawl_strdatetime", strdatetime("crawl_strdatetime"))
    both = spark.read.parquet(detail_path).select(*keys, F.lit(1).alias("d")).unionByName(unified.select(*keys, F.lit(0).alias("d")))
    return both.groupBy(*keys).agg(F.count_if(F.col("d") == 1).alias("detail_rows"), F.count_if(F.col("d") == 0).alias("unified_rows"))


@query("page_list_file", "select cast(page_id as int) as page_number, url from pages")
def page_list_file(spark, folder):
    lines = spark.read.parquet(f"{folder}/pages.parquet").selectExpr("cast(page_id as string) || ',' || url as value")
    path = shared_dir(spark, "page-list")
    lines.write.text(path)
    return read_page_urls(spark, path)


@query("page_files", "select page_id, length(html) as size from pages")
def page_files(spark, folder):
    return read_pages(spark, f"{folder}/pages.parquet").select("page_id", F.length("html").cast("bigint").alias("size"))


# --- streams ------------------------------------------------------------------------------------


def _attempts(spark, folder):
    """The attempt log as a stream of new files; event time in the session's time zone."""
    path = f"{folder}/events.parquet"
    rows = jobs.ingest_stream(spark, path, spark.read.parquet(path).schema)
    return rows.select(
        F.col("event_id").alias("attempt_id"),
        F.concat(F.lit("https://shop.example.com/"), F.col("user_id").cast("string")).alias("url"),
        F.when(F.col("event_type") != "error", F.col("value").cast("decimal(12,2)")).alias("retailprice"),
        F.col("ts").cast("timestamp").alias("crawl_datetime"),
    )


@query("stream_ingest", check_sql("select attempt_id, url, retailprice from v_log", "log"))
def stream_ingest(spark, folder):
    return jobs.drain(_attempts(spark, folder), "ingest").select("attempt_id", "url", "retailprice")


@query(
    "stream_dedupe",
    check_sql("select distinct url, strftime(ts, '%Y%m%d') || '_000000' as batch_id from v_log", "log"),
)
def stream_dedupe(spark, folder):
    rows = _attempts(spark, folder)
    rows = rows.select("url", batch_id(F.date_trunc("day", "crawl_datetime")).alias("batch_id"), "crawl_datetime")
    return jobs.drain(jobs.dedupe_stream(rows, ["url", "batch_id"], "crawl_datetime"), "dedupe").select("url", "batch_id")


@query(
    "stream_failures",
    check_sql(
        "select url, cast(epoch(w) as bigint) as window_start, count(*) as fail_count from (select url, unnest(generate_series(date_trunc('hour', ts) - interval 23 hour, "
        "date_trunc('hour', ts), interval 1 hour)) as w from v_log where retailprice is null) where w + interval 24 hour <= (select max(ts) from v_log where retailprice is null) "
        "- interval 1 hour group by all",
        "log",
    ),
)
def stream_failures(spark, folder):
    counts = jobs.drain(jobs.failure_stream(_attempts(spark, folder)), "failures")
    return counts.select("url", F.unix_timestamp("window_start").alias("window_start"), "fail_count")


@query(
    "stream_failures_current",
    check_sql(
        "select url, cast(epoch(w) as bigint) as window_start, count(*) as fail_count from (select url, unnest(generate_series(date_trunc('hour', ts) - interval 23 hour, "
        "date_trunc('hour', ts), interval 1 hour)) as w from v_log where retailprice is null) group by all",
        "log",
    ),
)
def stream_failures_current(spark, folder):
    """Counts of all windows, those still open included."""
    path, state = shared_dir(spark, "failure-log"), shared_dir(spark, "failure-state")
    jobs.log_updates(jobs.failure_stream(_attempts(spark, folder)), path, state).awaitTermination()
    counts = jobs.newest_counts(spark.read.parquet(path), ["url", "window_start"], "fail_count")
    return counts.select("url", F.unix_timestamp("window_start").alias("window_start"), "fail_count")


@query(
    "stream_keyed_sink",
    check_sql(
        "select url, batch_id, attempt_id from (select url, strftime(ts, '%Y%m%d') || '_000000' as batch_id, attempt_id, row_number() over (partition by url, strftime(ts, '%Y%m%d') "
        "order by attempt_id) as rn from v_log) where rn = 1",
        "log",
    ),
)
def stream_keyed_sink(spark, folder):
    rows = _attempts(spark, folder).select("url", batch_id(F.date_trunc("day", "crawl_datetime")).alias("batch_id"), "attempt_id")
    path = shared_dir(spark, "keyed")
    keys = ["url", "batch_id"]
    # The interim save and the final save bring the same rows; each is stored once.
    for _ in range(2):
        jobs.sink_batches(rows, path, shared_dir(spark, "keyed-state"), keys, ["attempt_id"], ["batch_id"]).awaitTermination()
    return spark.read.parquet(path).select("url", "batch_id", "attempt_id")
