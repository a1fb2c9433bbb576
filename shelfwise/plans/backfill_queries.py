"""Missing prices: nearest batch, lookups, fill chain, whole backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.clock import batch_seconds, crawl_seconds
from shelfwise.functions.text import blank_to_null
from shelfwise.operators import backfill, nearest
from shelfwise.plans.registry import query
from shelfwise.plans.views import check_sql, view

PREFER = ["rank", "listing_id"]
PRICES = backfill.PRICES

SECONDS = "cast(epoch(strptime(substr({}, 1, 14), '%Y%m%d%H%M%S')) as bigint)"
BATCH_SECONDS = "cast(epoch(strptime({}, '%Y%m%d_%H%M%S')) as bigint)"
BIG = "cast(100000000000 as hugeint)"

FEED = (
    "fd as (select listing_id, account_name as a, source as s, batch_id as b, rank, product_url as url, retailer_sku_name as name, "
    "nullif(final_sku_price, '') as f, nullif(original_sku_price, '') as o, "
    f"{SECONDS.format('crawl_strdatetime')} as cs, {BATCH_SECONDS.format('batch_id')} as bs from v_listing)"
)
MISSING = (
    "u as (select id, account_name as a, product_url as url, retailer_sku_name as name, nullif(final_sku_price, '') as f, "
    "nullif(original_sku_price, '') as o, savings, crawl_strdatetime as c, "
    f"{SECONDS.format('crawl_strdatetime')} as cs from v_unified), m as (select * from u where f is null or o is null)"
)


def _clean(df):
    return df.withColumns({p: blank_to_null(p) for p in PRICES})


@query(
    "null_price_rows",
    check_sql("select id, c as crawl_strdatetime from m where a = 'Bestbuy' and c between '20240105000000' and '20240120235959'", "unified", extra=MISSING),
)
def null_price_rows(spark, folder):
    rows = backfill.null_price_rows(_clean(view(spark, folder, "unified")), "Bestbuy", ("20240105000000", "20240120235959"))
    return rows.select("id", "crawl_strdatetime")


@query(
    "nearest_batch",
    check_sql(
        f"select p.a as account_name, t.s as source, p.cs as crawled_at, arg_min(t.b, abs(p.cs - t.bs) * {BIG} - t.bs) as batch_id from "
        "(select distinct a, cs from m) p join (select distinct a, s, b, bs from fd) t on p.a = t.a and abs(p.cs - t.bs) <= 172800 group by all",
        "unified", "listing", extra=f"{MISSING}, {FEED}",
    ),
)
def nearest_batch(spark, folder):
    missing = backfill.null_price_rows(_clean(view(spark, folder, "unified")))
    # Rows shrink to shops and seconds before they are repeated per feed.
    times = missing.select("account_name", crawl_seconds("crawl_strdatetime").alias("crawled_at")).distinct()
    probes = times.select("*", F.explode(F.array(*[F.lit(f) for f in ("main", "bsr", "promotion", "trend")])).alias("source"))
    batches = view(spark, folder, "listing").withColumn("batch_at", batch_seconds("batch_id"))
    return nearest.nearest_batch(probes, batches, ["account_name", "source"], "crawled_at", "batch_at", "batch_id")


@query(
    "nearest_batch_seoul",
    check_sql(
        f"select p.a as account_name, t.s as source, p.cs as crawled_at, arg_min(t.b, abs(p.cs - (t.bs - 32400)) * {BIG} - t.bs) as batch_id from "
        "(select distinct a, cs from m) p join (select distinct a, s, b, bs from fd) t on p.a = t.a and abs(p.cs - (t.bs - 32400)) <= 172800 group by all",
        "unified", "listing", extra=f"{MISSING}, {FEED}",
    ),
)
def nearest_batch_seoul(spark, folder):
    """Batch ids written in local time of a host nine hours ahead, crawl times in UTC."""
    missing = backfill.null_price_rows(_clean(view(spark, folder, "unified")))
    feeds = F.explode(F.array(*[F.lit(f) for f in ("main", "bsr", "promotion", "trend")])).alias("source")
    probes = missing.select("account_name", crawl_seconds("crawl_strdatetime").alias("crawled_at"), feeds)
    batches = view(spark, folder, "listing").withColumn("batch_at", batch_seconds("batch_id", "Asia/Seoul"))
    return nearest.nearest_batch(probes, batches, ["account_name", "source"], "crawled_at", "batch_at", "batch_id")


@query(
    "nearest_crawl_batch",
    check_sql(
        f"select p.cs as crawled_at, arg_min(t.b, abs(p.cs - t.cs) * {BIG} - t.cs) as batch_id from (select distinct cs from m where a = 'Walmart') p "
        "join (select cs, max(b) as b from fd where a = 'Walmart' and s = 'main' group by cs) t on abs(p.cs - t.cs) <= 172800 group by all",
        "unified", "listing", extra=f"{MISSING}, {FEED}",
    ),
)
def nearest_crawl_batch(spark, folder):
    missing = backfill.null_price_rows(_clean(view(spark, folder, "unified")), "Walmart")
    probes = missing.select("account_name", crawl_seconds("crawl_strdatetime").alias("crawled_at"))
    rows = view(spark, folder, "listing").where("source = 'main'").withColumn("feed_at", crawl_seconds("crawl_strdatetime"))
    return nearest.nearest_batch(probes, rows, ["account_name"], "crawled_at", "feed_at", "batch_id").drop("account_name")


BAND = (
    "select id, band_f as final_sku_price, band_o as original_sku_price from (select m.id, fd.f as band_f, fd.o as band_o, row_number() over "
    "(partition by m.id order by abs(m.cs - fd.cs), -fd.cs, rank, listing_id) as rn from m join fd on m.{key} = fd.{key} and m.a = fd.a and "
    "fd.s = 'main' and abs(m.cs - fd.cs) between 86400 and 172800) where rn = 1"
)


def _band(spark, folder, key):
    missing = backfill.null_price_rows(_clean(view(spark, folder, "unified")))
    rows = missing.select("id", "account_name", key, crawl_seconds("crawl_strdatetime").alias("at"))
    feed = _clean(view(spark, folder, "listing")).where("source = 'main'").withColumn("feed_at", crawl_seconds("crawl_strdatetime"))
    on = ["account_name", key]
    hits = nearest.band_nearest(rows.where(F.col(key).isNotNull()), feed.where(F.col(key).isNotNull()), on, "at", "feed_at", PRICES, PREFER)
    return rows.join(hits, [*on, "at"]).select("id", *PRICES)


@query("band_nearest_name", check_sql(BAND.format(key="name"), "unified", "listing", extra=f"{MISSING}, {FEED}"))
def band_nearest_name(spark, folder):
    return _band(spark, folder, "retailer_sku_name")


@query("band_nearest_url", check_sql(BAND.format(key="url"), "unified", "listing", extra=f"{MISSING}, {FEED}"))
def band_nearest_url(spark, folder):
    return _band(spark, folder, "product_url")


LOOKUPS = (
    "ul as (select * from (select *, row_number() over (partition by {by}s, b, url order by rank, listing_id) as rn from fd where url is not null) where rn = 1), "
    "nl as (select * from (select *, row_number() over (partition by {by}s, b, name order by rank, listing_id) as rn from fd where name is not null) where rn = 1)"
)


@query(
    "match_url_then_name",
    check_sql(
        "select m.id, case when ul.listing_id is not null then ul.f else nl.f end as final_sku_price, case when ul.listing_id is not null then ul.o else nl.o end "
        "as original_sku_price from m left join ul on ul.s = 'main' and ul.b = substr(m.c, 1, 8) || '_000000' and ul.url = m.url left join nl on nl.s = 'main' and "
        "nl.b = substr(m.c, 1, 8) || '_000000' and nl.name = m.name",
        "unified", "listing", extra=f"{MISSING}, {FEED}, {LOOKUPS.format(by='')}",
    ),
)
def match_url_then_name(spark, folder):
    rows = backfill.null_price_rows(_clean(view(spark, folder, "unified"))).select(
        "id", "product_url", "retailer_sku_name", F.concat(F.substring("crawl_strdatetime", 1, 8), F.lit("_000000")).alias("batch")
    )
    feed = _clean(view(spark, folder, "listing")).where("source = 'main'")
    hit = backfill.match_url_then_name(rows, feed, "batch", PRICES, PREFER)
    return hit.select("id", *[F.col(f"_hit.{p}").alias(p) for p in PRICES])


@query(
    "fill_chain",
    check_sql(
        "select m.id, coalesce(a.f, b.f, c.f) as final_sku_price, coalesce(a.o, b.o, c.o) as original_sku_price from m "
        + " ".join(
            f"left join ul {t} on {t}.s = '{s}' and {t}.b = substr(m.c, 1, 8) || '_000000' and {t}.url = m.url"
            for t, s in (("a", "main"), ("b", "bsr"), ("c", "promotion"))
        ),
        "unified", "listing", extra=f"{MISSING}, {FEED}, {LOOKUPS.format(by='')}",
    ),
)
def fill_chain(spark, folder):
    rows = backfill.null_price_rows(_clean(view(spark, folder, "unified"))).select(
        "id", "product_url", F.concat(F.substring("crawl_strdatetime", 1, 8), F.lit("_000000")).alias("batch"),
        *[F.lit(None).cast("string").alias(f"_{p}") for p in PRICES],
    )
    feeds = _clean(view(spark, folder, "listing"))
    for source in ("main", "bsr", "promotion"):
        feed = feeds.where(F.col("source") == source)
        rows = backfill.fill_chain(backfill.match_url_then_name(rows, feed, "batch", PRICES, PREFER, by_name=False), "_hit", PRICES)
    return rows.select("id", *[F.col(f"_{p}").alias(p) for p in PRICES])


@query(
    "enrich",
    check_sql(
        "select u.id, coalesce(u.f, r.f) as final_sku_price, coalesce(u.o, r.o) as original_sku_price from u left join (select * from (select *, row_number() over "
        "(partition by url order by b desc, rank, listing_id) as rn from fd where s = 'main' and b = (select max(b) from fd where s = 'main')) where rn = 1) r using (url)",
        "unified", "listing", extra=f"{MISSING}, {FEED}",
    ),
)
def enrich(spark, folder):
    feed = _clean(view(spark, folder, "listing")).where("source = 'main'")
    newest = feed.where(F.col("batch_id") == feed.agg(F.max("batch_id")).scalar())
    rows = _clean(view(spark, folder, "unified")).select("id", "product_url", *PRICES)
    return backfill.enrich(rows, newest, ["product_url"], PRICES, PREFER).select("id", *PRICES)


WHOLE = (
    f"{MISSING}, {FEED}, {LOOKUPS.format(by='a, ')}, "
    "d as (select account_name as a, crawl_strdatetime as c, max(batch_id) as b from v_detail where crawl_strdatetime is not null group by all), "
    f"p as (select m.*, case when m.a = 'Walmart' then m.cs else {BATCH_SECONDS.format('d.b')} end as probe from m left join d on m.a = d.a and m.c = d.c "
    "where m.a <> 'Bestbuy' or d.c is not null), "
    "times as (select a, s, case when a = 'Walmart' then cs else bs end as at, max(b) as b from fd group by all), "
    f"nb as (select p.id, t.s, arg_min(t.b, abs(p.probe - t.at) * {BIG} - t.at) as b from p join times t on p.a = t.a and abs(p.probe - t.at) <= 172800 group by all), "
    "h as (select p.id, p.a, nb.s, case when ul.listing_id is not null then ul.f when p.a = 'Amazon' then nl.f end as f, "
    "case when ul.listing_id is not null then ul.o when p.a = 'Amazon' then nl.o end as o from p join nb on p.id = nb.id "
    "left join ul on ul.a = p.a and ul.s = nb.s and ul.b = nb.b and ul.url = p.url left join nl on nl.a = p.a and nl.s = nb.s and nl.b = nb.b and nl.name = p.name), "
    "band as (select * from (select p.id, p.a, fd.s, fd.f, fd.o, row_number() over (partition by p.id, fd.s order by abs(p.cs - fd.cs), -fd.cs, rank, listing_id) as rn "
    "from p join fd on p.a = fd.a and abs(p.cs - fd.cs) between 86400 and 172800 and case when p.a = 'Amazon' then p.name = fd.name else p.url = fd.url end) where rn = 1), "
    "found as (select p.id, "
    "coalesce(hm.f, hb.f, case when p.a = 'Bestbuy' then hp.f end, bm.f, case when p.a = 'Amazon' then bb.f end) as found_f, "
    "coalesce(hm.o, case when p.a <> 'Amazon' then hb.o end, case when p.a = 'Bestbuy' then hp.o end, bm.o) as found_o from p "
    "left join h hm on hm.id = p.id and hm.s = 'main' left join h hb on hb.id = p.id and hb.s = 'bsr' left join h hp on hp.id = p.id and hp.s = 'promotion' "
    "left join band bm on bm.id = p.id and bm.s = 'main' left join band bb on bb.id = p.id and bb.s = 'bsr'), "
    "num as (select u.*, found_f, found_o, found_f is not null or found_o is not null as touched, coalesce(f, found_f) as nf, coalesce(o, found_o) as no, "
    "cast(replace(coalesce(o, found_o), '$', '') as decimal(12,2)) - cast(replace(coalesce(f, found_f), '$', '') as decimal(12,2)) as diff from u left join found using (id)), "
    "done as (select id, a as account_name, url as product_url, name as retailer_sku_name, nf as final_sku_price, no as original_sku_price, case when touched and a = 'Amazon' "
    "and diff is not null then case when diff < 0 then '-$' else '$' end || cast(cast(abs(diff) as decimal(12,2)) as varchar) else savings end as savings, "
    "c as crawl_strdatetime, touched as backfilled from num)"
)


PERIOD = ("20240105000000", "20240110235959")


def _sources(spark, folder):
    return view(spark, folder, "unified"), view(spark, folder, "detail"), view(spark, folder, "listing")


@query("backfill_prices", check_sql("select * from done", "unified", "detail", "listing", extra=WHOLE))
def backfill_prices(spark, folder):
    return backfill.backfill_prices(*_sources(spark, folder), PREFER)


@query("backfill_phases", check_sql("select * exclude (backfilled) from done", "unified", "detail", "listing", extra=WHOLE))
def backfill_phases(spark, folder):
    return backfill.backfill_phases(*_sources(spark, folder), PREFER, [PERIOD, None])


@query(
    "backfill_period",
    check_sql(
        "select id, case when inside then final_sku_price else f end as final_sku_price, case when inside then original_sku_price else o end as original_sku_price, "
        f"inside and backfilled as backfilled from (select done.*, u.f, u.o, u.c between '{PERIOD[0]}' and '{PERIOD[1]}' as inside from done join u using (id))",
        "unified", "detail", "listing", extra=WHOLE,
    ),
)
def backfill_period(spark, folder):
    return backfill.backfill_prices(*_sources(spark, folder), PREFER, rng=PERIOD).select("id", *PRICES, "backfilled")


@query(
    "backfill_stats",
    check_sql(
        "select b.a as account_name, count(*) filter (b.f is null or b.o is null) as missing_before, count(*) filter (backfilled) as updated, "
        "count(*) filter (final_sku_price is null or original_sku_price is null) as missing_after, "
        "count(*) filter ((b.f is null or b.o is null) and not backfilled) as failed from u b join done using (id) group by b.a",
        "unified", "detail", "listing", extra=WHOLE,
    ),
)
def backfill_stats(spark, folder):
    unified, detail, feeds = _sources(spark, folder)
    return backfill.backfill_stats(_clean(unified), backfill.backfill_prices(unified, detail, feeds, PREFER))


NEWEST = (
    f"{MISSING}, {FEED}, "
    "dt as (select product_url as url, nullif(final_sku_price, '') as f, nullif(original_sku_price, '') as o, crawl_strdatetime as c from v_detail where account_name = 'Amazon' "
    "and batch_id = (select max(batch_id) from v_detail where account_name = 'Amazon')), "
    "nm as (select * from (select *, row_number() over (partition by s, url order by rank, listing_id) as rn from fd x where a = 'Amazon' and s in ('main', 'bsr') and "
    "b = (select max(b) from fd y where y.a = 'Amazon' and y.s = x.s)) where rn = 1), "
    "df as (select dt.url, dt.c, coalesce(dt.f, mm.f, bb.f) as f, coalesce(dt.o, mm.o) as o from dt left join nm mm on mm.s = 'main' and mm.url = dt.url "
    "left join nm bb on bb.s = 'bsr' and bb.url = dt.url), "
    "one as (select * from (select *, row_number() over (partition by url order by c nulls last, f nulls last, o nulls last) as rn from df) where rn = 1)"
)


@query(
    "backfill_latest",
    check_sql(
        "select u.id, coalesce(u.f, one.f) as final_sku_price, coalesce(u.o, one.o) as original_sku_price from u left join one using (url) where u.a = 'Amazon' and "
        "substr(u.c, 1, 8) = (select max(substr(c, 1, 8)) from u where a = 'Amazon')",
        "unified", "detail", "listing", extra=NEWEST,
    ),
)
def backfill_latest(spark, folder):
    unified, detail, feeds = _sources(spark, folder)
    # One crawl a day: the rows of a run share their crawl time.
    unified = unified.withColumn("crawl_strdatetime", F.concat(F.substring("crawl_strdatetime", 1, 8), F.lit("0000000000")))
    return backfill.backfill_latest(unified, detail, feeds, "Amazon", PREFER).select("id", *PRICES)
