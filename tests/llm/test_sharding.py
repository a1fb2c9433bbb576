import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from shelfwise.llm.sharding import op5_balanced_shards, shard_documents
from tests.test_queries import FOLDER


def even(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_counts_slots_and_copies(spark):
    rows = op5_balanced_shards(spark, FOLDER).collect()
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    even(rows, 8)
    groups = defaultdict(set)
    for r in rows:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        groups[raw].add(r["shard"])
    assert len(rows) == len(text) and all(len(s) == 1 for s in groups.values())


def test_a_group_larger_than_a_shard(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("copy")).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    rows = shard_documents(docs, 8).collect()
    even(rows, 8)
    held = Counter(r["shard"] for r in rows if r["doc_id"] % 2 == 0)
    # 200 copies fill four shards of 50, not all eight.
    assert len(held) <= 5


def test_a_table_without_unlinked_rows(spark):
    """A third of the rows is one text, the rest are pairs: linked rows pay for each other's moves."""
    i = F.col("id")
    j = F.floor(i / 3) * 2 + i % 3 - 1
    text = F.when(i % 3 == 0, F.lit("copy")).otherwise(F.concat(F.lit("t"), F.least(j, 1599 - j)))
    docs = spark.range(2400).select(i.alias("doc_id"), text.alias("text"))
    groups = defaultdict(Counter)
    names = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = shard_documents(docs, 8).collect()
    even(rows, 8)
    for r in rows:
        groups[names[r["doc_id"]]][r["shard"]] += 1
    large = groups.pop("copy")
    # 800 copies fill two shards of 300 and most of a third.
    assert len(large) <= 4 and sum(n for _, n in large.most_common(3)) > 0.95 * 800, large
    pairs = [g for g in groups.values() if sum(g.values()) == 2]
    assert len(pairs) == 800 and sum(len(g) > 1 for g in pairs) <= 0.02 * len(pairs), sum(len(g) > 1 for g in pairs)


def test_links_between_documents(spark):
    docs = spark.range(160).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    links = docs.select("doc_id", F.floor(F.col("doc_id") / 5).alias("link"))
    rows = shard_documents(docs, 4, links=links).collect()
    even(rows, 4)
    groups = defaultdict(Counter)
    for r in rows:
        groups[r["doc_id"] // 5][r["shard"]] += 1
    # At random a quarter of a group's pairs share a shard.
    together = sum(n * (n - 1) for g in groups.values() for n in g.values()) / (len(groups) * 20)
    assert together > 0.6


def test_odd_rows(odd_docs, no_docs, all_null):
    rows = shard_documents(odd_docs).collect()
    even(rows, 8)
    assert len(rows) == odd_docs.count()
    assert shard_documents(no_docs).collect() == []
    assert [(r["size"], r["text_crc32"]) for r in shard_documents(all_null).collect()] == [(1, 0)] * 3


def test_no_python(spark):
    plan = op5_balanced_shards(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if w in plan]
