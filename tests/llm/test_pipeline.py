from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
from shelfwise.llm.fertility import labels_of, production
from tests.llm.test_jaccard import brute as components
from tests.llm.test_suffix import brute as repeats
from tests.test_queries import FOLDER


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, steps = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality rules", "n-gram Jaccard join", "suffix-array dedup", "mixing sources", "best-fit packing"]
    kept = {r["doc_id"] for r in production(docs, labels_of(spark, FOLDER)).where("_quality.kept").collect()}
    out = corpus_pipeline.stage(steps["quality rules"](spark, docs, FOLDER), "test")
    assert out.columns == columns and {r["doc_id"] for r in out.collect()} == kept

    want = {c for _, _, c in components([(r["doc_id"], r["text"]) for r in out.collect()], 5, 80)}
    out = corpus_pipeline.stage(steps["n-gram Jaccard join"](spark, out, FOLDER), "test")
    assert out.columns == columns and sorted(r["doc_id"] for r in out.collect()) == sorted(want)

    left = {i: n - gone for i, n, gone, _, _ in repeats([(r["doc_id"], r["text"]) for r in out.orderBy("doc_id").collect()])}
    out = corpus_pipeline.stage(steps["suffix-array dedup"](spark, out, FOLDER), "test")
    sizes = {r["doc_id"]: len(r["text"].encode()) for r in out.collect()}
    # Up to three bytes of a character cut apart go at each end of a removed passage.
    assert out.columns == columns and sizes.keys() == {i for i, n in left.items() if n} and all(left[i] - 60 <= n <= left[i] for i, n in sizes.items())

    before = Counter(r["doc_id"] for r in out.collect())
    out = corpus_pipeline.stage(steps["mixing sources"](spark, out, FOLDER), "test")
    after = Counter(r["doc_id"] for r in out.collect())
    assert out.columns == columns and after.keys() <= before.keys() and max(after.values()) <= 3

    rows = steps["best-fit packing"](spark, out, FOLDER).collect()
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == after


def test_odd_rows(spark, odd_docs, no_docs, all_null):
    """Each stage keeps the columns; what it does with odd rows is tested with its operator."""
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, odd_docs, FOLDER)
        assert k == 4 or out.columns == odd_docs.columns
        assert out.count() > 0
    assert corpus_pipeline.quality(spark, no_docs, FOLDER).count() == 0
    assert corpus_pipeline.quality(spark, all_null, FOLDER).count() == 0


def test_registered():
    names = [q for q in entry.queries() if q.startswith("op") or q == "pipeline"]
    assert [n.split("_")[0] for n in names if n != "pipeline" and n[2].isdigit()] == [f"op{k}" for k in range(1, 14)] and "pipeline" in names
