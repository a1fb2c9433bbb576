"""Stored tables: which files change, what readers see, which plans are made."""

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import listing, metrics, pages
from shelfwise.operators.dml import upsert
from shelfwise.plans import stored_queries as S
from shelfwise.plans.views import view
from shelfwise.schema import Evolution, catalog_columns, read_evolved
from shelfwise.session import shared_dir
from shelfwise.sources import tables
from shelfwise.streaming import jobs
from tests.test_queries import FOLDER


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/part-*", recursive=True)}


def rows(df):
    return sorted(map(str, df.collect()))


def test_upsert_leaves_the_files_of_other_partitions(spark):
    path, incoming = S._stored_and_incoming(spark, FOLDER)
    before = files(path)
    tables.upsert_partitioned(spark, path, incoming, S.PARTED, ["offer"], ["rank", F.desc("listing_id")], ["source", "batch_id"])
    after = files(path)
    changed = {tuple(f.split("/")[-3:-1]) for f in set(before) ^ set(after)}
    wanted = {(f"source={r['source']}", f"batch_id={r['batch_id']}") for r in incoming.select("source", "batch_id").distinct().collect()}
    assert changed == wanted and len(wanted) < len({os.path.dirname(f) for f in before})
    assert all(after[f] == t for f, t in before.items() if tuple(f.split("/")[-3:-1]) not in wanted)


def test_only_touched_partitions_are_listed(spark):
    path, incoming = S._stored_and_incoming(spark, FOLDER)
    some = tables.touched(spark.read.parquet(path), incoming, ["source", "batch_id"])
    some.collect()
    scan = some._jdf.queryExecution().executedPlan().collectLeaves().head()
    read, every = scan.metrics().apply("numPartitions").value(), len(glob.glob(f"{path}/source=*/batch_id=*"))
    assert read == some.select("source", "batch_id").distinct().count() < every


def test_null_partitions_are_rewritten_too(spark):
    path = shared_dir(spark, "null-part")
    spark.createDataFrame([("a", None, 1), ("b", "x", 2), ("c", "y", 3)], "k string, p string, v int").write.partitionBy("p").parquet(path)
    incoming = spark.createDataFrame([("b", "x", 20), ("d", None, 4)], "k string, p string, v int")
    tables.upsert_partitioned(spark, path, incoming, ["k", "p"], ["v"], ["v"], ["p"])
    assert rows(spark.read.parquet(path).select("k", "p", "v")) == rows(spark.createDataFrame([("a", None, 1), ("b", "x", 20), ("c", "y", 3), ("d", None, 4)], "k string, p string, v int"))
    with pytest.raises(ValueError):
        tables.upsert_partitioned(spark, path, incoming, ["k"], ["v"], ["v"], ["p"])


def test_upsert_twice_inserts_null_keys_twice(spark):
    old = spark.createDataFrame([("a", 1), (None, 0)], "k string, v int")
    new = spark.createDataFrame([("a", 2), (None, 5), (None, 5), ("b", 3)], "k string, v int")
    once = upsert(new, old, ["k"], ["v"], ["v"])
    twice = upsert(new, once, ["k"], ["v"], ["v"])
    assert once.where("k is null").count() == 3 and twice.where("k is null").count() == 5
    assert rows(once.where("k is not null")) == rows(twice.where("k is not null")) == rows(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"))


def test_readers_see_old_or_new_rows_during_a_reload(spark):
    table = "shelfwise_reload_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    tables.swap_table(spark.range(1000).withColumn("v", F.lit(0)), table)
    held = spark.table(table)
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            r = spark.table(table).agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).first()
            seen.add(tuple(r))

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 6):
        old = tables.swap_table(spark.table(table).withColumn("v", F.lit(v)), table)
        assert os.path.isdir(old.removeprefix("file:"))
    stop.set()
    reader.join()
    assert seen <= {(1000, v, v) for v in range(6)} and len(seen) > 1
    assert held.count() == 1000
    with pytest.raises(ValueError):
        tables.swap_table(spark.range(5), table)
    # A job that fails while it writes changes nothing.
    with pytest.raises(Exception, match="boom"):
        tables.swap_table(spark.table(table).withColumn("v", F.expr("if(id = 7, cast(raise_error('boom') as int), v)")), table)
    assert spark.table(table).agg(F.max("v")).first()[0] == 5
    spark.sql(f"DROP TABLE {table}")


def test_a_repeated_batch_changes_nothing_and_reads_nothing(spark):
    path = shared_dir(spark, "numbered-test")
    batch = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    tables.save_number(batch, path, "final", 0)
    tables.save_number(spark.createDataFrame([("b", 9)], "k string, v int"), path, "final", 1)
    first = rows(tables.settled(spark.read.parquet(path), ["k"], ["v"]))
    tables.save_number(batch, path, "final", 0)
    assert rows(tables.settled(spark.read.parquet(path), ["k"], ["v"])) == first and spark.read.parquet(path).count() == 4
    assert first == sorted(["Row(k='a', v=1)", "Row(k='b', v=9)", "Row(k=None, v=3)"])


def test_bucketed_tables_join_without_a_shuffle(spark):
    facts, feeds = S.laid_out(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = plan(S.bucketed_join(spark, facts, feeds))
        assert "SortMergeJoin" in joined and "Exchange" not in joined
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    calendar = shared_dir(spark, "calendar")
    spark.table(facts).select("account_name", "crawl_date").distinct().withColumn("week", F.expr("if(account_name = 'Amazon' and crawl_date = '20240105', 'w1', 'w2')")).write.parquet(calendar)
    days = spark.read.parquet(calendar).where("week = 'w1'")
    pruned = spark.table(facts).join(days, ["account_name", "crawl_date"], "left_semi").select("id")
    assert "dynamicpruning" in plan(pruned) and pruned.count() == view(spark, FOLDER, "unified").where("account_name = 'Amazon' and crawl_strdatetime like '20240105%'").count()


def test_figures_come_from_the_job_that_writes(spark):
    path = shared_dir(spark, "observed")
    source = shared_dir(spark, "observed-source")
    spark.range(1000).selectExpr("id", "case when id % 3 = 0 then null when id % 3 = 1 then '' else 'x' end as t").write.parquet(source)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    found = metrics.save_required(spark.read.parquet(source), ["t"], path)
    jobs_run = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)
    assert found == {"kept": 333, "dropped": 667, "without_t": 667} and spark.read.parquet(path).count() == 333
    # One job reads the schema, one reads the rows, counts and writes.
    assert len(jobs_run) <= 2
    assert metrics.save_required(spark.read.parquet(source).limit(0), ["t"], shared_dir(spark, "observed")) == {"kept": 0, "dropped": 0, "without_t": 0}


def test_pane_state_has_one_row_an_hour(spark):
    stream = S._with_country(S._attempts(spark, FOLDER))
    path, state = shared_dir(spark, "panes"), shared_dir(spark, "panes-state")
    query = jobs.log_updates(jobs.failure_panes(stream, ("url",)), path, state)
    query.awaitTermination()
    panes = query.recentProgress[0]["stateOperators"][0]["numRowsUpdated"]
    sliding = jobs.log_updates(jobs.failure_stream(stream), shared_dir(spark, "slides"), shared_dir(spark, "slides-state"))
    sliding.awaitTermination()
    assert panes * 10 < sliding.recentProgress[0]["stateOperators"][0]["numRowsUpdated"]


def test_panes_that_come_again_count_once(spark):
    log = spark.createDataFrame(
        [("u", "2024-01-01 10:00:00", "2024-01-01 11:00:00", 2, 0), ("u", "2024-01-01 10:00:00", "2024-01-01 11:00:00", 5, 1), ("u", "2024-01-01 10:00:00", "2024-01-01 11:00:00", 5, 1),
         ("u", "2023-12-31 10:00:00", "2023-12-31 11:00:00", 9, 0), ("v", "2024-01-02 10:00:00", "2024-01-02 11:00:00", 1, 1)],
        "url string, pane_start string, pane_end string, fail_count bigint, _batch bigint",
    ).withColumns({"pane_start": F.col("pane_start").cast("timestamp"), "pane_end": F.col("pane_end").cast("timestamp")})
    got = jobs.failures_since(log, F.lit("2024-01-01 11:00:00").cast("timestamp")).collect()
    assert [tuple(r) for r in got] == [("u", 5)]


def test_generations_keep_their_filters(spark):
    a, b = shared_dir(spark, "gen"), shared_dir(spark, "gen")
    spark.createDataFrame([(1, "x", "202401051200001234")], "id int, old string, t string").write.parquet(a)
    spark.createDataFrame([(2, "y")], "id bigint, new string").withColumn("t", F.lit("2024-02-01 00:00:00").cast("timestamp")).write.parquet(b)
    # The second generation grew a column later: its files differ among themselves.
    spark.createDataFrame([(3, "z", 7)], "id bigint, new string, more int").write.mode("append").parquet(b)
    change = Evolution(rename={"old": "new"}, cast={"id": "bigint", "t": "timestamp"}, order=("id", "new"))
    got = read_evolved(spark, [a, b], change)
    assert got.columns[:2] == ["id", "new"] and rows(got.select("id", "new", "more", "generation", F.date_format("t", "yyyyMMdd HHmmss.SSSS"))) == rows(
        spark.createDataFrame([(1, "x", None, 1, "20240105 120000.1234"), (2, "y", None, 2, "20240201 000000.0000"), (3, "z", 7, 2, None)], "id bigint, new string, more int, generation int, `date_format(t, yyyyMMdd HHmmss.SSSS)` string")
    )
    assert "PushedFilters: [IsNotNull(id)" in plan(got.where("id = 2 and generation = 2")) or "PushedFilters: [EqualTo" in plan(got.where("id = 2 and generation = 2"))


def test_rules_as_data_take_the_first_that_matches(spark):
    rules = spark.createDataFrame(
        [("s", "f", "a(.)", 2, True), ("s", "f", "b(.)", 1, True), ("s", "f", "c(.)", 0, False), ("s", "g", "(z)", 1, True), ("t", "f", "(q)", 1, True)],
        "mall string, data_field string, pattern string, priority int, is_active boolean",
    )
    some = spark.createDataFrame([(1, "s", "a1 b2 c3"), (2, "s", "a1 b"), (3, "t", "a1 b2"), (4, None, "b2"), (5, "s", None)], "id int, mall string, html string")
    got = {r["id"]: (r["f"], r["g"]) for r in pages.extract_by_rules(some, rules, ["f", "g"], ["id"], ["mall"]).collect()}
    assert got == {1: ("2", None), 2: ("1", None), 3: (None, None), 4: (None, None), 5: (None, None)}
    down = {r["id"]: r["f"] for r in pages.extract_by_rules(some, rules, ["f"], ["id"], ["mall"], descending=True).collect()}
    assert down[1] == "1"


def test_ranks_of_the_null_group_go_on(spark):
    first = spark.createDataFrame([(None, 7), (1, 3)], "g int, rank int")
    second = spark.createDataFrame([(None, 1), (None, 2), (1, 1), (2, 1)], "g int, rank int")
    got = listing.continue_rank(first, second, ["g"], ["rank"]).collect()
    assert sorted((r["g"] or 0, r["continued_rank"]) for r in got) == [(0, 8), (0, 9), (1, 4), (2, 1)]


def test_page_folders_are_shelved(spark, tmp_path, monkeypatch):
    """The folder of one-page files has few folders at its top, and files in folders below are read."""
    pages = [(i, "p" * i) for i in range(600)]
    spark.createDataFrame(pages, "page_id bigint, html string").write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(S, "shared_dir", lambda spark, purpose: str(tmp_path / purpose))
    found = S.page_file_folder(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [(i, i + 1) for i, _ in pages]
    top = [p for p in (tmp_path / "page-folder").iterdir() if p.is_dir()]
    assert len(top) <= S.SHELVES and len(list((tmp_path / "page-folder").glob("*/page_id=*/*.txt"))) == len(pages)


def test_columns_of_a_database_without_the_sessions_views(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("view_of_the_session")
    spark.sql(f"CREATE DATABASE columns_of_one LOCATION '{tmp_path}'")
    try:
        spark.range(1).write.option("path", str(tmp_path / "t")).saveAsTable("columns_of_one.t")
        assert [(r.table_name, r.column_name) for r in catalog_columns(spark, "columns_of_one").collect()] == [("t", "id")]
    finally:
        spark.sql("DROP DATABASE columns_of_one CASCADE")
        spark.catalog.dropTempView("view_of_the_session")
