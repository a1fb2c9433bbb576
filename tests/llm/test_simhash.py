import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from shelfwise.llm.simhash import fingerprint, op10_simhash, simhash_documents, within_radius
from tests.test_queries import FOLDER


def test_fingerprint_by_hand(spark):
    text = "alpha beta beta gamma_delta  of\nof"
    words = spark.createDataFrame([(w,) for w in text.split()], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    votes = [0] * 64
    for r in words:
        for b in range(64):
            votes[b] += max(1, len(r["w"]) - 2) * (1 if r["h"] >> b & 1 else -1)
    want = sum(1 << b for b in range(64) if votes[b] > 0)
    got = {r["k"]: r["_fp"] % (1 << 64) for r in fingerprint(spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, t string"), ["k"], "t").collect()}
    assert got == {1: want, 2: 0, 3: 0}


def test_search_finds_all(spark):
    import random

    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(60)]
    prints = {b ^ sum(1 << p for p in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(8)} | {0, (1 << 64) - 1}
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    df = spark.createDataFrame([(p,) for p in signed], "_fp bigint")
    got = {(x["_q"] % (1 << 64), x["_fp"] % (1 << 64), x["distance"]) for x in within_radius(df.toDF("_q"), df, 3, 6).collect()}
    want = {(a, b, (a ^ b).bit_count()) for a in prints for b in prints if (a ^ b).bit_count() <= 3}
    assert got == want
    assert within_radius(df.toDF("_q"), df, 3, 6).count() == len(want)


def test_documents(spark):
    rows = sorted(op10_simhash(spark, FOLDER).collect(), key=lambda x: x["doc_id"])
    docs = [x["text"] or "" for x in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()]
    same = defaultdict(set)
    for k, (x, text) in enumerate(zip(rows, docs, strict=True)):
        n, after = len(text), docs[(k + 1) % len(docs)]
        edited = text[: n - n // 4] + after[: n // 4]
        assert x["n_chars"] == n and x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        near = 1 - (int(x["fingerprint"], 16) ^ int(x["edited_fingerprint"], 16)).bit_count() / 64
        follow = 1 - (int(x["fingerprint"], 16) ^ int(rows[(k + 1) % len(rows)]["fingerprint"], 16)).bit_count() / 64
        assert (x["near_edited"], x["near_next"]) == (near, follow)
        same[text].add(x["fingerprint"])
    assert all(len(v) == 1 for v in same.values())
    counts = [int(x["fingerprint"], 16) for x in rows]
    for x in rows:
        if x["doc_id"] % 100 == 0:
            assert x["n_near"] == sum((int(x["fingerprint"], 16) ^ c).bit_count() <= 3 for c in counts)
        else:
            assert x["n_near"] is None
    assert sum(x["near_edited"] for x in rows) > 0.2 * len(rows) + sum(x["near_next"] for x in rows)


def test_odd_rows(odd_docs, no_docs, all_null):
    rows = simhash_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {x["fingerprint"] for x in rows if x["n_chars"] == 0} == {"0" * 16}
    assert simhash_documents(no_docs).collect() == []
    assert len(simhash_documents(all_null).collect()) == 3


def test_no_python(spark):
    plan = op10_simhash(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if w in plan]
