"""A key that holds a third of the rows is spread over tasks."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import dml, listing
from shelfwise.operators.backfill import enrich
from shelfwise.operators.nearest import nearest

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(spark, n=150_000):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 9973).cast("string")))
    df = spark.range(0, n, 1, 12).select(
        "id", hot.alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("name"), (F.col("id") % 50).alias("page_number"),
        F.lit("u").alias("product_url"), F.when(F.col("id") % 2 == 0, F.sha2(F.lit("x"), 256)).alias("item"),
    )
    return df


def _final_plan(df):
    counted = df.agg(F.sum(F.hash(*df.columns)))
    counted.collect()
    return counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_first_appearance_join_is_split(small_partitions):
    df = listing.duplicate_trace(_rows(small_partitions), "code", "name", "page_number", "product_url", "id", 5)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "skew=true" in plan


def test_peer_lookup_is_split(small_partitions):
    assert "skew=true" in _final_plan(dml.fill_from_peers(_rows(small_partitions), "code", "item", ["id"]).select("id", "item", "name"))


def test_enrichment_is_split(small_partitions):
    rows = _rows(small_partitions).select("id", "code", "name", "item")
    right = rows.select("code", "item", "id")
    assert "skew=true" in _final_plan(enrich(rows, right, ["code"], ["item"], ["id"]))


def test_windows_of_a_hot_key_hold_seconds_not_rows(small_partitions):
    spark = small_partitions
    left = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") % 500).alias("t"))
    right = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") % 700).alias("r"))
    got = nearest(left, right, ["k"], "t", "r", 100)
    assert got.count() == 500 and got.where("t <> r").count() == 0
