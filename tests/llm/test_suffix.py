import hashlib
import random

import numpy as np

from shelfwise.llm import suffix
from shelfwise.llm.suffix import common_prefixes, multikey_order, op2_suffix_dedup, padded, suffix_dedup
from tests.llm.conftest import prose
from tests.test_queries import FOLDER


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) with a table of all strings of 100 bytes."""
    seen, out = set(), []
    for i, text in rows:
        raw = (text or "").encode()
        cover = bytearray(len(raw))
        for p in range(len(raw) - 99):
            s = raw[p : p + 100]
            if s in seen:
                cover[p : p + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(b for b, c in zip(raw, cover, strict=True) if not c)
        spans = sum(cover[p] and (p == 0 or not cover[p - 1]) for p in range(len(raw)))
        out.append((i, len(raw), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out


def results(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = suffix_dedup(docs.repartition(3)).select("_row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "_text").collect()
    for r in got:
        left = r["_text"].encode() if r["kept"] is None else bytes(r["kept"])
        assert hashlib.sha256(left).hexdigest() == r["kept_sha256"] and len(left) == r["n_bytes"] - r["n_removed"]
    return sorted(tuple(r)[:5] for r in got)


def test_all_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert sorted(map(tuple, op2_suffix_dedup(spark, FOLDER).collect())) == brute(docs)


def test_planted_repeats(spark):
    r, shared = random.Random(8), [prose(100 + i, 60) for i in range(4)]
    rows = [(0, shared[0][:99]), (1, shared[0][:100]), (2, "é" * 80), (3, "é" * 50 + shared[1]), (4, "ab" * 400), (5, "x" + "ab" * 60 + "y"), (6, None), (7, ""), (8, "\0" * 150), (9, "q" + "\0" * 120)]
    for i in range(10, 60):
        parts = [prose(1000 + i, r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, 200)
            parts += [s[a : a + r.choice([99, 100, 101, 150, 400])], prose(2000 + i, r.randint(0, 20))]
        rows.append((i, "".join(parts)))
    rows += [(60 + i, rows[20 + i % 5][1]) for i in range(15)]
    # A line in every text, with other text around it; near copies of one text.
    line = prose(77, 9)[:60]
    rows += [(100 + i, prose(3000 + i, 12) + line + prose(4000 + i, 12)) for i in range(60)]
    base = prose(78, 200)
    rows += [(200 + i, base[: 7 * i] + "#" + base[7 * i + 1 :]) for i in range(80)]
    assert results(spark, rows) == sorted(brute(rows))


def test_many_ranges(spark):
    """Small ranges: runs of equal suffixes reach over several boundaries."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        base = prose(5, 80)
        rows = [(i, f"{i} " + base[i % 7 :] + f" {i * i}") for i in range(60)]
        assert results(spark, rows) == sorted(brute(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_very_long_text(spark):
    text = prose(9, 400_000)
    rows = [(1, text), (2, text[1_500_000:1_700_000] + prose(10, 50))]
    got = dict((r[0], r[2]) for r in results(spark, rows))
    assert got[2] >= 200_000 and got[1] < 2000


def test_multikey_order():
    r = random.Random(1)
    values = [bytes(r.choice(b"ab\0") for _ in range(r.randint(0, 30))) for _ in range(500)]
    rows, sizes = padded(values, 32)
    order = multikey_order(rows, sizes)
    key = lambda v: (v + b"\0" * (32 - len(v)), len(v))
    assert [values[i] for i in order] == sorted(values, key=key)
    lcp = common_prefixes(rows, sizes, order)
    for k in range(1, 500):
        a, b = values[order[k - 1]], values[order[k]]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert lcp[k] == n
    assert lcp[0] == -1 and np.array_equal(np.sort(order), np.arange(500))


def test_odd_rows(odd_docs, no_docs, all_null):
    rows = suffix_dedup(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {*rows[0]["_row"].asDict()} == {*odd_docs.columns} - {"text"}
    by_id = {}
    for r in rows:
        by_id.setdefault(r["_row"]["doc_id"], []).append((r["n_bytes"], r["n_removed"], r["n_spans"]))
    assert by_id[3][0][1] == by_id[3][0][0] and by_id[2][0][1] == 0 and by_id[5] == [(0, 0, 0)]
    assert by_id[11] == [(50_000, 49_999, 1)] and by_id[12][0] == by_id[12][1]
    assert suffix_dedup(no_docs).collect() == []
    assert [r["n_removed"] for r in suffix_dedup(all_null).collect()] == [0, 0, 0]


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    assert [suffix.ranges_for(n) for n in (0, 1, suffix.RANGE_ROWS, suffix.RANGE_ROWS + 1, 40 * suffix.RANGE_ROWS)] == [1, 1, 1, 2, 40]
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    columns = ["_row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = sorted(map(tuple, suffix_dedup(rows).select(*columns).collect()))
    monkeypatch.setattr(suffix, "RANGE_ROWS", 50)
    assert sorted(map(tuple, suffix_dedup(rows).select(*columns).collect())) == want
