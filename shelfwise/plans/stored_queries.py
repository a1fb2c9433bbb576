"""Stored tables changed in place, figures counted while writing, streams against stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfwise.functions.clock import batch_id, crawl_time, strdatetime
from shelfwise.functions.text import blank_to_null
from shelfwise.operators import backfill, dml, listing, metrics, quality
from shelfwise.operators.report import report_frames
from shelfwise.operators.tracker import failed_counts
from shelfwise.plans.backfill_queries import WHOLE
from shelfwise.plans.change_queries import CHECKED, HALF, OLD, ORDER, QUALITY
from shelfwise.plans.registry import query
from shelfwise.plans.sink_queries import _attempts
from shelfwise.plans.views import check_sql, view
from shelfwise.schema import Evolution, catalog_columns, read_evolved
from shelfwise.session import shared_dir
from shelfwise.sources import sinks, tables
from shelfwise.sources.readers import read_pages
from shelfwise.streaming import jobs

PARTED = ["source", "product_url", "batch_id"]
#: Incoming rows are those of two feeds of the second and third day.
INCOMING = "source in ('main', 'bsr') and batch_id between '20240102_000000' and '20240103_000000'"


def _rows(spark, folder):
    return view(spark, folder, "listing").select("source", "product_url", "batch_id", "rank", "listing_id", "offer", "sku_status")


# --- changes by partition -----------------------------------------------------------------------

STORED = (
    "rows_ as (select source, product_url, batch_id, rank, listing_id, offer, sku_status, row_number() over (partition by source, product_url, batch_id order by rank nulls last, listing_id) as rn from v_listing), "
    "stored as (select * exclude (rn) from rows_ where rn = 1 and product_url is not null and listing_id % 3 <> 0), "
    f"inc as (select source, product_url, batch_id, rank, listing_id, 'new' as offer, sku_status, row_number() over (partition by source, product_url, batch_id order by rank nulls last, listing_id desc) as rn from v_listing where {INCOMING}), "
    "fresh as (select * exclude (rn) from inc where rn = 1 and product_url is not null)"
)


def _stored_and_incoming(spark, folder):
    rows = _rows(spark, folder)
    first = listing.dedupe_first(rows.where("product_url is not null"), PARTED, ["rank", "listing_id"]).where("listing_id % 3 <> 0")
    path = shared_dir(spark, "parted")
    first.repartition("source", "batch_id").write.partitionBy("source", "batch_id").parquet(path)
    return path, rows.where(INCOMING).withColumn("offer", F.lit("new"))


@query(
    "upsert_partitioned",
    check_sql(
        "select coalesce(s.source, f.source) as source, coalesce(s.product_url, f.product_url) as product_url, coalesce(s.batch_id, f.batch_id) as batch_id, "
        "case when s.source is not null then s.rank else f.rank end as rank, coalesce(s.listing_id, f.listing_id) as listing_id, coalesce(f.offer, s.offer) as offer, "
        "case when s.source is not null then s.sku_status else f.sku_status end as sku_status from stored s full outer join fresh f on s.source = f.source and s.product_url = f.product_url "
        "and s.batch_id = f.batch_id union all select * exclude (rn) from inc where product_url is null",
        "listing", extra=STORED,
    ),
)
def upsert_partitioned(spark, folder):
    path, incoming = _stored_and_incoming(spark, folder)
    tables.upsert_partitioned(spark, path, incoming, PARTED, ["offer"], ["rank", F.desc("listing_id")], ["source", "batch_id"])
    return spark.read.parquet(path).select("source", "product_url", "batch_id", "rank", "listing_id", "offer", "sku_status")


@query(
    "change_partitions",
    check_sql("select listing_id, case when source = 'bsr' and batch_id >= '20240110_000000' and offer is null then '0' else offer end as offer from stored", "listing", extra=STORED),
)
def change_partitions(spark, folder):
    path, _ = _stored_and_incoming(spark, folder)
    late = (F.col("source") == "bsr") & (F.col("batch_id") >= "20240110_000000")
    tables.change_partitions(spark, path, late, lambda rows: dml.fill_default(rows, {"offer": "0"}), ["source", "batch_id"])
    return spark.read.parquet(path).select("listing_id", "offer")


@query(
    "upsert_null_keys",
    check_sql(
        "select source, product_url, listing_id, offer from (select * from old union all select * from added) union all select source, product_url, listing_id, offer from v_listing "
        f"where product_url is null and batch_id > '{HALF}' union all select source, product_url, listing_id, offer from v_listing where product_url is null and batch_id > '{HALF}'",
        "listing", extra=OLD,
    ),
)
def upsert_null_keys(spark, folder):
    """Rows whose key has a NULL never conflict: a second save of the same rows inserts them again, and changes nothing else."""
    rows = _rows(spark, folder).where("product_url is null or product_url <> ''")
    old = listing.dedupe_first(rows.where(f"product_url is not null and batch_id <= '{HALF}'"), ["source", "product_url"], ["batch_id", *ORDER])
    incoming = rows.where(f"batch_id > '{HALF}'")
    once = dml.upsert(incoming, old, ["source", "product_url"], [], ORDER)
    return dml.upsert(incoming, once, ["source", "product_url"], [], ORDER).select("source", "product_url", "listing_id", "offer")


@query("reload_table", "select page_id, upper(url) as url from pages")
def reload_table(spark, folder):
    table = f"shelfwise_list_{uuid.uuid4().hex}"
    tables.swap_table(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url"), table)
    # The new content is made from the table that it replaces.
    tables.swap_table(spark.table(table).select("page_id", F.upper("url").alias("url")), table)
    path = tables.location(spark, table)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(path)


# --- laid out for joins -------------------------------------------------------------------------


def laid_out(spark, folder) -> tuple[str, str]:
    """Unified facts and listing rows as two catalog tables with the same buckets; their names."""
    facts = view(spark, folder, "unified").withColumn("crawl_date", F.substring("crawl_strdatetime", 1, 8))
    feeds = view(spark, folder, "listing").where("product_url <> '' and source = 'main'")
    feeds = listing.dedupe_first(feeds, ["account_name", "product_url"], ["rank", "listing_id"]).select("account_name", "product_url", "rank", "sku_status", "offer")
    names = []
    for kind, rows, parts in (("facts", facts, ["account_name", "crawl_date"]), ("feeds", feeds, ["account_name"])):
        names.append(f"shelfwise_{kind}_{uuid.uuid4().hex}")
        tables.save_laid_out(rows, names[-1], shared_dir(spark, kind), parts, "product_url", 8)
    return names[0], names[1]


def bucketed_join(spark, facts: str, feeds: str):
    both = tables.join_in_place(spark.table(facts), spark.table(feeds), "product_url", ["account_name"])
    return both.select("id", "account_name", "crawl_date", "rank", "sku_status")


@query(
    "detail_join_bucketed",
    check_sql(
        "select u.id, u.account_name, substr(u.crawl_strdatetime, 1, 8) as crawl_date, l.rank, l.sku_status from v_unified u left join (select *, row_number() over (partition by account_name, product_url "
        "order by rank nulls last, listing_id) as rn from v_listing where source = 'main' and product_url <> '') l on l.rn = 1 and l.account_name = u.account_name and l.product_url = u.product_url",
        "unified", "listing",
    ),
)
def detail_join_bucketed(spark, folder):
    return bucketed_join(spark, *laid_out(spark, folder))


# --- figures counted while writing --------------------------------------------------------------


def _figures(spark, found: dict[str, int]):
    return spark.createDataFrame(list(found.items()), "metric string, figure bigint")


def _union(rows: dict[str, str], source: str) -> str:
    return " union all ".join(f"select '{name}' as metric, cast(count(*) filter ({test}) as bigint) as figure from {source}" for name, test in rows.items())


LACKS_NAME, LACKS_URL = "coalesce(retailer_sku_name, '') = ''", "coalesce(product_url, '') = ''"


@query(
    "save_required",
    check_sql(
        _union({"kept": f"not ({LACKS_NAME}) and not ({LACKS_URL})", "dropped": f"{LACKS_NAME} or {LACKS_URL}", "without_retailer_sku_name": LACKS_NAME, "without_product_url": LACKS_URL,
                "stored": f"not ({LACKS_NAME}) and not ({LACKS_URL})"}, "v_listing"),
        "listing",
    ),
)
def save_required(spark, folder):
    path = shared_dir(spark, "required")
    found = metrics.save_required(view(spark, folder, "listing"), ["retailer_sku_name", "product_url"], path)
    return _figures(spark, found | {"stored": spark.read.parquet(path).count()})


def _backfill_figures() -> str:
    rows = {}
    for account in ("Amazon", "Bestbuy", "Walmart"):
        rows[f"{account}_updated"] = f"account_name = '{account}' and backfilled"
        rows[f"{account}_failed"] = f"account_name = '{account}' and not backfilled and (final_sku_price is null or original_sku_price is null)"
    return check_sql(_union(rows, "done"), "unified", "detail", "listing", extra=WHOLE)


@query("save_backfilled", _backfill_figures())
def save_backfilled(spark, folder):
    sources = [view(spark, folder, name) for name in ("unified", "detail", "listing")]
    return _figures(spark, metrics.save_backfilled(*sources, ["rank", "listing_id"], shared_dir(spark, "backfilled")))


@query("save_issues", QUALITY + _union({"total": "true"} | {k: f"issue_type = '{k}'" for k in quality.KINDS}, "i"))
def save_issues(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_id", *[f"{e} as {c}" for c, e in CHECKED.items()])
    return _figures(spark, metrics.save_issues(quality.issues(rows, "detail", ["event_id"]), shared_dir(spark, "issues")))


@query("issue_totals", QUALITY + "select issue_type, count(*) as issues from i group by rollup (issue_type)")
def issue_totals(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_id", *[f"{e} as {c}" for c, e in CHECKED.items()])
    return quality.issue_summary(quality.issues(rows, "detail", ["event_id"]), total=True)


@query(
    "save_reconciled",
    check_sql(
        _union({f"{a}_{what}": f"account_name = '{a}' and {test}" for a in ("Amazon", "Bestbuy", "Walmart")
                for what, test in (("read", "true"), ("inserted", "nullif(final_sku_price, '') is not null"), ("errors", "nullif(final_sku_price, '') is null"))}, "v_unified"),
        "unified",
    ),
)
def save_reconciled(spark, folder):
    rows = view(spark, folder, "unified")
    found = metrics.save_reconciled(rows, ["Amazon", "Bestbuy", "Walmart"], blank_to_null("final_sku_price").isNotNull(), shared_dir(spark, "reconciled"))
    return _figures(spark, found)


# --- several generations of files ---------------------------------------------------------------


@query(
    "read_evolved",
    check_sql(
        "select id, case id % 3 when 0 then 1 when 1 then 2 else 3 end as generation, account_name as channel, case when id % 3 = 0 then null else status_badge end as sku_status, "
        "case when id % 3 = 2 then 'w1' end as calendar_week, crawl_strdatetime from v_detail",
        "detail",
    ),
)
def evolved(spark, folder):
    """Three generations: the first with old names and crawl times as digits, the second renamed, the third with a new column and crawl times as timestamps."""
    rows = view(spark, folder, "detail").select("id", "account_name", "status_badge", "crawl_strdatetime")
    change = Evolution(
        rename={"account_name": "channel", "status_badge": "sku_status"}, cast={"id": "bigint", "crawl_strdatetime": "timestamp"}, add={"offer": "string"}, drop=("old",),
    )
    parts = [
        rows.where("id % 3 = 0").withColumn("old", F.lit(1)).drop("status_badge").withColumn("id", F.col("id").cast("int")),
        rows.where("id % 3 = 1").withColumnRenamed("account_name", "channel"),
        _third(rows.where("id % 3 = 2")),
    ]
    folders = []
    for part in parts:
        folders.append(shared_dir(spark, "generation"))
        part.write.parquet(folders[-1])
    found = read_evolved(spark, folders, change)
    return found.select("id", "generation", "channel", "sku_status", "calendar_week", strdatetime("crawl_strdatetime").alias("crawl_strdatetime"))


def _third(rows):
    return rows.withColumnsRenamed({"account_name": "channel", "status_badge": "sku_status"}).withColumns({"calendar_week": F.lit("w1"), "crawl_strdatetime": crawl_time("crawl_strdatetime")})


CATALOG = {"part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"], "pages": ["page_id", "url", "html"]}


@query(
    "catalog_columns",
    " union all ".join(
        f"select '{t}' as table_name, {i} as position, '{c}' as column_name, case typeof(any_value({c})) when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double' "
        f"when 'VARCHAR' then 'string' end as type, true as nullable from {t}"
        for t, columns in CATALOG.items() for i, c in enumerate(columns, 1)
    ),
)
def catalog(spark, folder):
    """Columns of the tables that a database of the catalog holds."""
    name = f"shelfwise_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark, 'catalog')}'")
    for table in CATALOG:
        path = shared_dir(spark, f"catalog-{table}")
        spark.read.parquet(f"{folder}/{table}.parquet").write.option("path", path).saveAsTable(f"{name}.{table}")
    found = catalog_columns(spark, name)
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return found


# --- files of pages and reports -----------------------------------------------------------------


#: Folders over those of the pages: a shelf is written by one task, moved in one step and listed by one task.
SHELVES = 256


@query("page_file_folder", "select page_id, length(html) + 1 as size from pages")
def page_file_folder(spark, folder):
    """Stored pages as a folder of files, one page each; Spark's text writer ends a file with a line feed."""
    path = shared_dir(spark, "page-folder")
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html")
    pages = pages.withColumn("shelf", F.pmod(F.xxhash64("page_id"), F.lit(SHELVES)))
    pages.repartition("shelf").write.partitionBy("shelf", "page_id").text(path)
    found = read_pages(spark, path, form="files")
    return found.select(F.regexp_extract("path", "page_id=([0-9]+)", 1).cast("bigint").alias("page_id"), F.length("html").cast("bigint").alias("size"))


@query(
    "export_report",
    check_sql(
        "select 'All_Results' as part, count(*) as rows, count(retailprice) as priced, sum(retailprice) as total from v_sales union all select 'With_Prices', count(*), count(*), sum(retailprice) from v_sales "
        "where retailprice is not null",
        "sales",
    ),
)
def export_report(spark, folder):
    """The parts of a report, written and read back."""
    frames = report_frames(view(spark, folder, "sales").select("orderkey", "linenumber", "brand", "retailprice"))
    path = shared_dir(spark, "report")
    sinks.export_report(frames, path)
    read = lambda part: spark.read.option("header", True).schema("orderkey bigint, linenumber int, brand string, retailprice decimal(12,2)").csv(f"{path}/{part}")
    parts = [read(part).agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("rows"), F.count("retailprice").alias("priced"), F.sum("retailprice").cast("decimal(38,2)").alias("total"))
             for part in ("All_Results", "With_Prices")]
    return parts[0].unionByName(parts[1])


# --- streams against stored tables --------------------------------------------------------------


def _keyed(rows):
    """Attempts with a key that is NULL now and then."""
    url = F.when(F.col("attempt_id") % 50 != 7, F.col("url"))
    return rows.withColumns({"url": url, "batch_id": batch_id(F.date_trunc("day", "crawl_datetime"))}).select("attempt_id", "url", "batch_id", "crawl_datetime")


KEYED = "k as (select attempt_id, case when attempt_id % 50 <> 7 then url end as url, strftime(ts, '%Y%m%d') || '_000000' as batch_id from v_log)"


@query(
    "stream_new_only",
    check_sql(
        "select distinct url, batch_id from k where url is not null and not exists (select 1 from k s where s.attempt_id % 4 = 1 and s.url = k.url and s.batch_id = k.batch_id) "
        "union all select url, batch_id from k where url is null",
        "log", extra=KEYED,
    ),
)
def stream_new_only(spark, folder):
    """What a stored table lacks: keys repeat within the stream and between it and the table."""
    table = view(spark, folder, "log").withColumn("crawl_datetime", F.col("ts").cast("timestamp")).where("attempt_id % 4 = 1")
    path = shared_dir(spark, "stored-keys")
    _keyed(table).select("url", "batch_id").write.parquet(path)
    rows = jobs.new_only_stream(_keyed(_attempts(spark, folder)), spark.read.parquet(path), ["url", "batch_id"], "crawl_datetime", ["attempt_id"])
    return jobs.drain(rows, "new-only").select("url", "batch_id")


PANES = (
    "log_ as (select *, case attempt_id % 3 when 0 then 'nl' when 1 then 'it' else 'de' end as country_code from v_log), "
    "ended as (select date_trunc('hour', max(ts)) + interval 1 hour as now_ from v_log where retailprice is null)"
)


def _with_country(rows):
    return rows.withColumn("country_code", F.expr("case attempt_id % 3 when 0 then 'nl' when 1 then 'it' else 'de' end"))


@query(
    "stream_failures_panes",
    check_sql(
        "select country_code, url, cast(count(*) as bigint) as fail_count from log_, ended where retailprice is null and ts >= now_ - interval 24 hour and ts < now_ group by all",
        "log", extra=PANES,
    ),
)
def stream_failures_panes(spark, folder):
    """Failures of the day before the end of the last pane, per country and URL, from hourly panes that a stream keeps."""
    by = ("country_code", "url")
    path, state = shared_dir(spark, "pane-log"), shared_dir(spark, "pane-state")
    jobs.log_updates(jobs.failure_panes(_with_country(_attempts(spark, folder)), by), path, state).awaitTermination()
    updates = spark.read.parquet(path)
    return jobs.failures_since(updates, updates.agg(F.max("pane_end")).scalar(), by=by)


@query(
    "failed_counts_by_country",
    check_sql(
        "select country_code, url, count(*) as fail_count from log_ where retailprice is null and ts >= timestamp '2024-01-30 12:00:00' - interval 24 hour group by all",
        "log", extra=PANES,
    ),
)
def failed_counts_by_country(spark, folder):
    rows = _with_country(view(spark, folder, "log").withColumn("crawl_datetime", F.col("ts").cast("timestamp")))
    return failed_counts(rows, "2024-01-30 12:00:00", by=("country_code", "url"))


@query(
    "stream_numbered_sink",
    check_sql(
        "select url, batch_id, min(attempt_id) as attempt_id from k group by url, batch_id", "log", extra=KEYED,
    ),
)
def stream_numbered_sink(spark, folder):
    """An interim save of half of the rows and a final save of all, the latter's micro-batch written twice: each key once when read."""
    path = shared_dir(spark, "numbered")
    rows = _keyed(_attempts(spark, folder)).drop("crawl_datetime")
    tables.sink_numbered(rows.where("attempt_id % 2 = 0"), path, shared_dir(spark, "numbered-state"), "interim").awaitTermination()
    for _ in range(2):
        # Another checkpoint with the same name: the first micro-batch comes again, as after a failure.
        tables.sink_numbered(rows, path, shared_dir(spark, "numbered-state"), "final").awaitTermination()
    return tables.settled(spark.read.parquet(path), ["url", "batch_id"], ["attempt_id"]).select("url", "batch_id", "attempt_id")


# --- newest batches and zones -------------------------------------------------------------------

# Batch ids of one shop from a day on are epoch seconds.
MIXED = "case when account_name = 'Walmart' and substr(batch_id, 1, 8) >= '20240120' then cast({} as {}) else batch_id end"
SEC = "cast(epoch(strptime(batch_id, '%Y%m%d_%H%M%S')) as bigint)"


def _mixed(rows):
    return rows.withColumn("batch_id", F.expr(MIXED.format("unix_timestamp(batch_id, 'yyyyMMdd_HHmmss')", "string")))


@query(
    "latest_batch_mixed",
    check_sql(
        f"select listing_id, account_name, source from (select *, {SEC} as b, max({SEC}) over (partition by account_name, source) as newest from v_listing) where b = newest", "listing",
    ),
)
def latest_batch_mixed(spark, folder):
    """The newest batch of each feed where one shop's ids changed from dates to epoch seconds within its feeds."""
    return listing.latest_batch(_mixed(view(spark, folder, "listing"))).select("listing_id", "account_name", "source")


LATEST_ALL = (
    "u as (select id, account_name as a, product_url as url, nullif(final_sku_price, '') as f, nullif(original_sku_price, '') as o, crawl_strdatetime as c from v_unified), "
    f"fd as (select listing_id, account_name as a, source as s, {SEC} as b, rank, product_url as url, nullif(final_sku_price, '') as f, nullif(original_sku_price, '') as o from v_listing), "
    f"dt as (select account_name as a, product_url as url, nullif(final_sku_price, '') as f, nullif(original_sku_price, '') as o, crawl_strdatetime as c from v_detail d where {SEC.replace('batch_id', 'd.batch_id')} = "
    f"(select max({SEC.replace('batch_id', 'e.batch_id')}) from v_detail e where e.account_name = d.account_name)), "
    "nm as (select * from (select *, row_number() over (partition by a, s, url order by rank nulls last, listing_id) as rn from fd x where s in ('main', 'bsr') and "
    "b = (select max(b) from fd y where y.a = x.a and y.s = x.s)) where rn = 1), "
    "df as (select dt.a, dt.url, dt.c, coalesce(dt.f, mm.f, bb.f) as f, coalesce(dt.o, mm.o) as o from dt left join nm mm on mm.a = dt.a and mm.s = 'main' and mm.url = dt.url "
    "left join nm bb on bb.a = dt.a and bb.s = 'bsr' and bb.url = dt.url), "
    "one as (select * from (select *, row_number() over (partition by a, url order by c nulls last, f nulls last, o nulls last) as rn from df) where rn = 1)"
)


@query(
    "backfill_latest_all",
    check_sql(
        "select u.id, coalesce(u.f, one.f) as final_sku_price, coalesce(u.o, one.o) as original_sku_price from u left join one on one.a = u.a and one.url = u.url where "
        "substr(u.c, 1, 8) = (select max(substr(v.c, 1, 8)) from u v where v.a = u.a)",
        "unified", "detail", "listing", extra=LATEST_ALL,
    ),
)
def backfill_latest_all(spark, folder):
    """Newest batches of all shops, one of which changed from dated ids to epoch seconds."""
    unified, detail, feeds = (view(spark, folder, name) for name in ("unified", "detail", "listing"))
    unified = unified.withColumn("crawl_strdatetime", F.concat(F.substring("crawl_strdatetime", 1, 8), F.lit("0000000000")))
    found = backfill.backfill_latest(unified, _mixed(detail), _mixed(feeds), ["Amazon", "Bestbuy", "Walmart"], ["rank", "listing_id"])
    return found.select("id", *backfill.PRICES)
