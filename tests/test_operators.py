"""Operators on small frames: brute force, repetition, skew, sinks, streams."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import backfill, dml, listing, nearest, pages, quality, report, tracker
from shelfwise.schema import UNIFIED_COLUMNS, Evolution, align, catalog_columns, evolve
from shelfwise.session import shared_dir
from shelfwise.sources import readers, sinks
from shelfwise.streaming import jobs

RNG = random.Random(7)
HOUR = 3600


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("lo,hi", [(0, 48 * HOUR), (24 * HOUR, 48 * HOUR), (0, 10), (3, 10)])
def test_nearest_matches_brute_force(spark, lo, hi):
    span = 40 * hi if hi < HOUR else 20 * hi
    # One key holds most rows.
    keys = ["hot"] * 8 + ["a", "b"]
    left = [(RNG.choice(keys), RNG.randrange(span)) for _ in range(300)]
    right = [(RNG.choice(keys), RNG.randrange(span)) for _ in range(300)]
    left += [(k, t + hi) for k, t in right[:20]] + [(k, t - lo) for k, t in right[:20] if t >= lo]
    want = set()
    for k, t in set(left):
        near = [(abs(t - r), -r) for kk, r in set(right) if kk == k and lo <= abs(t - r) <= hi]
        if near:
            want.add((k, t, -min(near)[1]))
    got = nearest.nearest(
        spark.createDataFrame(left, "k string, t bigint"), spark.createDataFrame(right, "k string, r bigint"),
        ["k"], "t", "r", hi, lo,
    )
    assert set(rows(got)) == want


def test_band_takes_the_nearest_row_even_if_empty(spark):
    right = spark.createDataFrame(
        [("x", 0, None, 1), ("x", 0, "late", 2), ("x", 200000, "far", 1)], "k string, r bigint, v string, rank int"
    )
    left = spark.createDataFrame([("x", 90000), ("x", 100), ("y", 90000)], "k string, t bigint")
    got = nearest.band_nearest(left, right, ["k"], "t", "r", ["v"], ["rank"])
    assert rows(got) == [("x", 90000, None)]


def _listing(spark, data):
    return spark.createDataFrame(data, "source string, rank int, product_url string, offer string, promotion_type string, price string")


MERGE = [
    ("main", 3, "u1", "m3", None, ""), ("main", 1, "u1", "m1", None, None), ("bsr", 5, "u1", "b5", None, "$5"),
    ("bsr", 9, "u1", "b9", None, "$9"), ("bsr", 2, "u2", "b2", None, None), ("bsr", 4, "u2", "b4", None, "$4"),
    ("promotion", 1, "u2", "p1", "Early", "$1"), ("promotion", 6, "u2", "p6", "Late", "$6"), ("promotion", 2, "u3", "p2", "Only", None),
    ("main", 1, "", "none", None, None), ("main", 1, None, "none", None, None),
]


def test_merge_rules(spark):
    got = listing.merge_feeds(_listing(spark, MERGE), "product_url", ["offer", "price"], fill=("price",))
    by_url = {r.product_url: r for r in got.collect()}
    assert set(by_url) == {"u1", "u2", "u3"}
    u1, u2, u3 = by_url["u1"], by_url["u2"], by_url["u3"]
    assert (u1.page_type, u1.offer, u1.price, u1.main_rank, u1.bsr_rank) == ("main", "m1", "$5", 1, 9)
    assert (u2.page_type, u2.offer, u2.price, u2.bsr_rank, u2.promotion_rank, u2.promotion_type) == ("bsr", "b2", "$4", 4, 6, "Late")
    assert (u3.page_type, u3.price, u3.promotion_type) == ("promotion", None, "Only")


def test_merge_does_not_depend_on_row_order(spark):
    want = None
    for _ in range(3):
        data = MERGE[:]
        RNG.shuffle(data)
        got = rows(listing.merge_feeds(_listing(spark, data).repartition(5), "product_url", ["offer"]).na.fill("-").na.fill(-1))
        want = want or got
        assert got == want


def test_best_rank_variant(spark):
    got = listing.merge_feeds(_listing(spark, MERGE), "product_url", ["offer"], strict_parity=False)
    assert {r.product_url: (r.bsr_rank, r.promotion_type) for r in got.collect()}["u2"] == (2, "Early")


def test_rank_cap_and_hot_group(spark):
    df = spark.range(5000).select(F.lit("hot").alias("g"), F.col("id").alias("o"))
    got = listing.assign_rank(df, ["g"], ["o"], 300)
    assert got.count() == 300 and got.agg(F.max("o")).first()[0] == 299


def test_pack_pages_renders_repeats_in_order(spark):
    df = spark.createDataFrame([("a", 10), ("a", 2), ("a", 2), ("b", 1)], "name string, page int")
    packed = listing.pack_pages(listing.duplicate_report(df, "name", "page", 20), "name", "page")
    assert rows(packed) == [("a", 3, "2, 2, 10")]


def test_null_groups_ranks_and_keys(spark):
    """NULL is a group, NULL ranks come last, NULL keys are never lost."""
    df = spark.createDataFrame([(None, 2), (None, None), (None, 1), ("a", 5)], "g string, o int")
    assert sorted(((r.g, r.o, r.n) for r in listing.number_rows(df, ["g"], ["o"], "n").collect()), key=str) == sorted(
        [(None, 1, 1), (None, 2, 2), (None, None, 3), ("a", 5, 1)], key=str
    )
    prices = spark.createDataFrame([(None, 1.0), (None, 3.0), ("b", 2.0)], "brand string, p double").selectExpr("brand", "cast(p as decimal(12,2)) p")
    assert {r.brand: (r.priced, float(r.median_price)) for r in report.price_stats(prices, "p", ["brand"]).collect()} == {None: (2, 2.0), "b": (1, 2.0)}
    new = spark.createDataFrame([("x", 1), (None, 2), (None, 3), ("y", 4)], "k string, v int")
    old = spark.createDataFrame([("x", 0), (None, 9)], "k string, v int")
    assert sorted(r.v for r in dml.insert_absent(new, old, ["k"], ["v"]).collect()) == [0, 2, 3, 4, 9]
    path = shared_dir(spark, "null-keys")
    for _ in range(2):
        sinks.append_new(new, path, ["k"], ["v"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 4]


def test_newest_batch_by_time(spark):
    """Epoch seconds and dates in one column: the later time wins, per shop."""
    df = spark.createDataFrame(
        [("A", "main", "1764547200"), ("A", "main", "20240101_000000"), ("B", "main", "20230101_000000"), (None, "main", "20220101_000000"), ("B", "main", None)],
        "account_name string, source string, batch_id string",
    )
    got = {(r.account_name, r.batch_id) for r in listing.latest_batch(df).collect()}
    assert got == {("A", "1764547200"), ("B", "20230101_000000"), (None, "20220101_000000")}


def test_continue_rank_of_empty_first_part(spark):
    first = spark.createDataFrame([], "b string, rank int")
    second = spark.createDataFrame([("x", 2, 1), ("x", 1, 7), ("x", 1, 3)], "b string, page int, o int")
    got = listing.continue_rank(first, second, ["b"], ["page", "o"])
    assert rows(got.select("page", "o", "continued_rank")) == [(1, 3, 1), (1, 7, 2), (2, 1, 3)]


def test_numbering_of_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.lit("cold")).alias("g"), ((F.col("id") * 7919) % 3001).alias("o")
    )
    numbered = listing.number_rows(df, ["g"], ["o"], "n").collect()
    for group in ("hot", "cold"):
        placed = sorted((r.o, r.n) for r in numbered if r.g == group)
        assert [n for _, n in placed] == list(range(1, len(placed) + 1))


def test_selector_lists_without_dedupe(spark):
    stored = spark.createDataFrame([("t", "a", 1), ("t", "b", 2)], "k string, v string, priority int")
    default = spark.createDataFrame([("t", "b", 1), ("t", "c", 2)], "k string, v string, priority int")
    names = lambda df: [r.v for r in df.orderBy("position").collect()]
    assert names(listing.merge_selectors(stored, default, ["k"], "v")) == ["a", "b", "c"]
    assert names(listing.merge_selectors(stored, default, ["k"], "v", db_first=False)) == ["b", "c", "a"]
    assert names(listing.merge_selectors(stored, default, ["k"], "v", dedupe=False)) == ["a", "b", "b", "c"]


# --- backfill -----------------------------------------------------------------------------------

UNIFIED = "id bigint, account_name string, product_url string, retailer_sku_name string, final_sku_price string, original_sku_price string, savings string, crawl_strdatetime string"
LISTING = "listing_id bigint, account_name string, source string, batch_id string, rank int, product_url string, retailer_sku_name string, final_sku_price string, original_sku_price string, crawl_strdatetime string"
DETAIL = "account_name string, batch_id string, crawl_strdatetime string"
T0 = "202511081200000000"
B0 = "20251108_110000"


def _backfill(spark, unified, feeds, detail=(("Amazon", B0, T0), ("Bestbuy", B0, T0)), **options):
    listed = [(i, *f) for i, f in enumerate(feeds)]
    return backfill.backfill_prices(
        spark.createDataFrame(unified, UNIFIED), spark.createDataFrame(list(detail), DETAIL), spark.createDataFrame(listed, LISTING),
        ["rank", "listing_id"], **options,
    )


def _one(df, id=1):
    return [r for r in df.collect() if r.id == id][0]


def test_url_row_without_price_stops_the_name_fallback(spark):
    feeds = [
        ("Amazon", "main", B0, 1, "u", "other", None, None, T0),
        ("Amazon", "main", B0, 2, "v", "n", "$8.00", "$9.00", T0),
        ("Amazon", "bsr", B0, 1, "u", "n", "$7.00", "$99.00", T0),
    ]
    got = _one(_backfill(spark, [(1, "Amazon", "u", "n", None, None, None, T0)], feeds))
    assert (got.final_sku_price, got.original_sku_price, got.backfilled) == ("$7.00", None, True)
    by_name = _one(_backfill(spark, [(1, "Amazon", "w", "n", None, None, None, T0)], feeds))
    assert (by_name.final_sku_price, by_name.original_sku_price, by_name.savings) == ("$8.00", "$9.00", "$1.00")


def test_band_is_used_only_for_what_is_missing(spark):
    day_before = "202511071100000000"
    feeds = [
        ("Amazon", "main", "20251101_000000", 1, "z", "n", "$5.00", "$6.00", day_before),
        ("Amazon", "bsr", B0, 1, "u", "n", "$7.00", None, T0),
    ]
    got = _one(_backfill(spark, [(1, "Amazon", "u", "n", None, None, None, T0)], feeds))
    assert (got.final_sku_price, got.original_sku_price, got.savings) == ("$7.00", "$6.00", "-$1.00")


def test_account_without_detail(spark):
    feeds = [("Bestbuy", "main", B0, 1, "u", "n", "$5.00", None, T0), ("Walmart", "main", "1762599600", 1, "u", "n", "$3.00", "$4.00", T0)]
    data = [(1, "Bestbuy", "u", "n", None, None, None, T0), (2, "Walmart", "u", "n", None, None, "$0.10", T0), (3, "Other", "u", "n", None, None, None, T0)]
    got = _backfill(spark, data, feeds, detail=(("Amazon", B0, T0),))
    assert _one(got, 1).final_sku_price is None and not _one(got, 1).backfilled
    assert (_one(got, 2).final_sku_price, _one(got, 2).savings) == ("$3.00", "$0.10")
    assert _one(got, 3).final_sku_price is None and got.count() == 3


def test_promotion_is_the_last_link(spark):
    feeds = [
        ("Bestbuy", "main", B0, 1, "u", "n", None, None, T0), ("Bestbuy", "bsr", B0, 1, "u", "n", "$2.00", None, T0),
        ("Bestbuy", "promotion", B0, 1, "u", "n", "$1.00", "$3.00", T0),
    ]
    got = _one(_backfill(spark, [(1, "Bestbuy", "u", "n", "", None, "$9", T0)], feeds))
    assert (got.final_sku_price, got.original_sku_price, got.savings) == ("$2.00", "$3.00", "$9")


def test_backfill_is_idempotent_and_respects_the_range(spark):
    feeds = [("Walmart", "main", "1762599600", 1, "u", "n", "$3.00", "$4.00", T0)]
    data = [(1, "Walmart", "u", "n", None, None, None, T0)]
    out = _backfill(spark, data, feeds, rng=("20251101", "20251102"))
    assert not _one(out).backfilled
    once = _backfill(spark, data, feeds).drop("backfilled")
    twice = backfill.backfill_prices(
        once, spark.createDataFrame([], DETAIL), spark.createDataFrame([(0, *feeds[0])], LISTING), ["rank", "listing_id"]
    )
    assert _one(twice).final_sku_price == "$3.00" and not _one(twice).backfilled


# --- changes ------------------------------------------------------------------------------------


def test_upsert_twice_is_upsert_once(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "B", "Y"), (2, "BB", "YY"), (3, None, "z")], "k int, v string, w string")
    once = dml.upsert(new, old, ["k"], ["v"], ["v"])
    assert rows(once.na.fill("-")) == [(1, "a", "x"), (2, "B", "y"), (3, "-", "z")]
    assert rows(dml.upsert(new, once, ["k"], ["v"], ["v"]).na.fill("-")) == rows(once.na.fill("-"))


def test_insert_absent_keeps_stored_rows(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "z"), (2, "c"), (2, "b")], "k int, v string")
    assert rows(dml.insert_absent(new, old, ["k"], ["v"])) == [(1, "a"), (2, "b")]


def test_fill_from_peers_takes_the_newest(spark):
    df = spark.createDataFrame([(1, "n", "old"), (2, "n", "new"), (3, "n", None), (4, "m", None), (5, None, None)], "id int, name string, item string")
    got = {r.id: r.item for r in dml.fill_from_peers(df, "name", "item", ["id"]).collect()}
    assert got == {1: "old", 2: "new", 3: "new", 4: None, 5: None}


def test_evolve_twice_changes_nothing_more(spark):
    df = spark.createDataFrame([(1, "x", 2)], "order_no int, mother string, gone int")
    change = Evolution(
        rename={"mother": "page_type", "absent": "b"}, add={"asin": "string"}, cast={"order_no": "string"}, drop=("gone",), order=("page_type",)
    )
    once = evolve(df, change)
    assert once.dtypes == [("page_type", "string"), ("order_no", "string"), ("asin", "string")]
    assert evolve(once, change).dtypes == once.dtypes


def test_align_casts_and_fills(spark):
    df = spark.createDataFrame([("m", "12", "n/a")], "item string, main_rank string, bsr_rank string")
    out = align(df, "Amazon", {}).first()
    assert len(out) == len(UNIFIED_COLUMNS) == 40
    assert (out.item, out.account_name, out.main_rank, out.bsr_rank, out.offer) == ("m", "Amazon", 12, None, None)


def test_catalog_columns(spark):
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("some_table")
    found = [r for r in catalog_columns(spark).collect() if r.table_name == "some_table"]
    assert [(r.column_name, r.type) for r in found] == [("a", "int")]


def test_first_failing_rule_wins(spark):
    df = spark.createDataFrame([("u", None, "$0", "10 inch", "x", "6")], "url string, item string, final_sku_price string, screen_size string, count_of_reviews string, star_rating string")
    found = {r.field: r.issue_type for r in quality.issues(df, "s", ["url"]).collect()}
    assert found == {
        "item": "NULL_VALUE", "final_sku_price": "OUTLIER", "screen_size": "OUTLIER", "count_of_reviews": "FORMAT_ISSUE", "star_rating": "OUTLIER",
    }


# --- reports ------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 50, 51])
def test_exact_median(spark, n):
    amounts = [round(RNG.choice([5, 900, 1999.99, 60000]) + RNG.random() * 2000, 2) for _ in range(n)]
    df = spark.createDataFrame([("g", a) for a in amounts] + [("empty", None)], "g string, p double")
    df = df.withColumn("p", F.col("p").cast("decimal(12,2)"))
    got = report.exact_median(df, "p", ["g"]).collect()
    assert [(r.g, float(r.median_price)) for r in got] == [("g", pytest.approx(statistics.median(amounts), abs=1e-6))]
    assert float(report.price_stats(df, "p", []).first().median_price) == pytest.approx(statistics.median(amounts), abs=1e-6)


def test_price_stats_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "g string, p decimal(12,2)")
    assert report.price_stats(empty, "p", ["g"]).collect() == []
    assert report.price_stats(empty, "p", []).first().asDict() == {"mean_price": None, "min_price": None, "max_price": None, "median_price": None, "priced": 0}


def test_rates_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "retailprice decimal(12,2)")
    assert report.success_rate(empty).first()[0] == 0.0
    assert {r.metric: r.value for r in report.summary(empty).collect()}["Success Rate (%)"] == "0.0"
    assert set(report.report_frames(empty)) == {"All_Results", "With_Prices", "Summary"}


def test_retry_keeps_urls_below_the_limit(spark):
    log = spark.createDataFrame(
        [("a", None, "2024-01-01 10:00:00")] * 3 + [("b", None, "2024-01-01 10:00:00"), ("c", None, "2023-12-30 10:00:00"), ("d", 1.0, "2024-01-01 10:00:00")],
        "url string, retailprice double, at string",
    ).withColumn("crawl_datetime", F.to_timestamp("at"))
    targets = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("d",)], "url string")
    got = tracker.retry_targets(targets, log, "2024-01-01 12:00:00")
    assert rows(got) == [("b", 1), ("c", 0), ("d", 0)]


def test_crawl_targets_limit(spark):
    df = spark.createDataFrame([("nl", "m", True)] * 5, "country string, mall_name string, is_active boolean")
    assert tracker.crawl_targets(df, "nl", "m", 2).count() == 2


# --- pages --------------------------------------------------------------------------------------


def test_rules_come_from_a_table(spark):
    table = spark.createDataFrame(
        [("nl", "price", r"<b>(.*?)</b>", 2, True), ("nl", "price", r"<i>(.*?)</i>", 1, True), ("de", "price", "(x)", 1, True)],
        "country string, data_field string, pattern string, priority int, is_active boolean",
    )
    rules = pages.load_rules(table, F.col("country") == "nl")
    page = spark.createDataFrame([(1, "<i> </i><b>9</b>"), (2, "<i>7</i><b>9</b>"), (3, "none")], "id int, html string")
    assert rows(pages.extract(page, rules, ["id"]).na.fill("-")) == [(1, "9"), (2, "7"), (3, "-")]
    assert rows(pages.extract(page, rules, ["id"], descending=True).na.fill("-")) == [(1, "9"), (2, "9"), (3, "-")]


def test_carousel_belongs_to_the_section_before_it(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "s1"), (1, 3, None), (1, 4, "s2"), (1, 5, None), (2, 1, None)], "page int, pos int, s string")
    got = pages.attach_section(df, "page", "pos", "s")
    assert [(r.page, r.pos, r.nearest_section) for r in got.orderBy("page", "pos").collect()] == [
        (1, 1, None), (1, 2, "s1"), (1, 3, "s1"), (1, 4, "s2"), (1, 5, "s2"), (2, 1, None),
    ]


# --- sources and sinks --------------------------------------------------------------------------


def test_page_list_file(spark, tmp_path):
    (tmp_path / "pages.txt").write_text("1,https://a.example.com/?x=1,2\nbad line\n2,\n 3 , https://b.example.com\n")
    got = readers.read_page_urls(spark, str(tmp_path / "pages.txt"))
    assert rows(got) == [(1, "https://a.example.com/?x=1,2"), (3, "https://b.example.com")]


def test_pages_from_files(spark, tmp_path):
    for name in ("a.html", "b.html"):
        (tmp_path / name).write_text(f"<p>\n{name}</p>")
    got = readers.read_pages(spark, str(tmp_path), form="files")
    assert sorted(r.html for r in got.collect()) == ["<p>\na.html</p>", "<p>\nb.html</p>"]


def test_saving_twice_stores_once(spark):
    df = spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 1)], "url string, n int")
    path = shared_dir(spark, "twice")
    for _ in range(2):
        sinks.append_new(df, path, ["url"], ["n"])
    assert rows(spark.read.parquet(path)) == [("u1", 1), ("u2", 1)]


def test_snapshot_is_never_overwritten(spark):
    df, folder = spark.range(3), shared_dir(spark, "snap")
    path = sinks.snapshot(df, folder, "t", "1")
    with pytest.raises(Exception):
        sinks.snapshot(df, folder, "t", "1")
    assert spark.read.parquet(path).count() == 3


def test_export_names_and_report(spark):
    df = spark.createDataFrame([("a", 'say "x", y', 1.5), ("b", None, None)], "url string, t string, retailprice double")
    folder = shared_dir(spark, "export")
    path = sinks.export_csv(df, folder, "nl", "shop", "20240101000000")
    assert path.endswith("/20240101000000_nl_shop.csv")
    back = spark.read.option("header", True).option("escape", '"').schema(df.schema).csv(path)
    assert rows(back.na.fill("-").na.fill(0.0)) == [("a", 'say "x", y', 1.5), ("b", "-", 0.0)]
    sinks.export_report(report.report_frames(df), folder + "/report")
    assert spark.read.option("header", True).csv(folder + "/report/With_Prices").count() == 1


def test_fanout_and_dual_write(spark):
    df = spark.createDataFrame([("u", 1), ("u", 2)], "url string, n int")
    raw, unique = shared_dir(spark, "r"), shared_dir(spark, "u")
    sinks.fanout(df, ["url"], ["n"], raw, unique)
    assert spark.read.parquet(raw).count() == 2 and rows(spark.read.parquet(unique)) == [("u", 1)]
    detail, unified = shared_dir(spark, "d"), shared_dir(spark, "un")
    sinks.write_both(df, align(df.withColumnRenamed("url", "product_url"), "Amazon"), detail, unified)
    assert spark.read.parquet(unified).where("account_name = 'Amazon'").count() == 2


# --- streams ------------------------------------------------------------------------------------


def test_keyed_stream_survives_new_files_and_restart(spark, tmp_path):
    source, path, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    make = lambda data: spark.createDataFrame(data, "url string, batch_id string, n int")
    make([("a", "1", 1), ("a", "1", 2)]).coalesce(1).write.parquet(source)
    run = lambda: jobs.sink_batches(
        jobs.ingest_stream(spark, source, make([]).schema, max_files=1), path, state, ["url", "batch_id"], ["n"]
    ).awaitTermination()
    run()
    make([("a", "1", 3), ("a", "2", 4)]).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert rows(spark.read.parquet(path)) == [("a", "1", 1), ("a", "2", 4)]


def test_dedupe_stream_across_files(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "url string, at timestamp"
    make = lambda data: spark.createDataFrame(data, "url string, s string").select("url", F.to_timestamp("s").alias("at"))
    make([("hot", f"2024-01-01 00:00:{i:02d}") for i in range(60)] + [("b", "2024-01-01 00:00:00")]).write.parquet(source)
    make([("hot", "2024-01-01 01:00:00"), ("c", "2024-01-01 01:00:00")]).write.mode("append").parquet(source)
    stream = jobs.ingest_stream(spark, source, spark.createDataFrame([], schema).schema, max_files=1)
    got = jobs.drain(jobs.dedupe_stream(stream, ["url"], "at"), "dedupe-test")
    assert sorted(r.url for r in got.collect()) == ["b", "c", "hot"]
