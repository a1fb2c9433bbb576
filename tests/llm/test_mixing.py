from collections import defaultdict

from shelfwise.llm.mixing import mix_sources, op1_mix_sources, water_fill
from tests.test_queries import FOLDER


def filled(total, items):
    """Shares of (weight, cap) by handing out what is left again and again."""
    share, free = [0.0] * len(items), set(range(len(items)))
    while free and total - sum(share) > 1e-9:
        left = total - sum(share)
        weights = sum(items[i][0] for i in free)
        over = [i for i in free if share[i] + left * items[i][0] / weights >= items[i][1]]
        if not over:
            for i in free:
                share[i] += left * items[i][0] / weights
            break
        worst = min(over, key=lambda i: (items[i][1] - share[i]) / items[i][0])
        step = (items[worst][1] - share[worst]) / items[worst][0]
        for i in free:
            share[i] += step * items[i][0]
        free.remove(worst)
    return share


def test_water_fill(spark):
    items = [(1.0, 5.0), (2.0, 50.0), (3.0, 9.0), (1.0, 0.0), (2.0, 1000.0)]
    df = spark.createDataFrame([(i, 60.0, w, c) for i, (w, c) in enumerate(items)], "i int, total double, w double, cap double")
    got = [r["t"] for r in water_fill(df, (), "total", "w", "cap", "t").orderBy("i").collect()]
    assert all(abs(a - b) < 1e-6 for a, b in zip(got, filled(60.0, items), strict=True))


def test_targets_and_totals(spark):
    rows = op1_mix_sources(spark, FOLDER).collect()
    words = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "text").collect()
    size = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in words}
    by_source = defaultdict(int)
    for r in words:
        by_source[r["source"]] += size[r["doc_id"]]
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    want = dict(zip(names, filled(sum(by_source.values()), [(1.0 + k % 3, 3.0 * by_source[s]) for k, s in enumerate(names)]), strict=True))
    taken = defaultdict(int)
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by_source[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
    for s in names:
        assert want[s] * 0.85 <= taken[s] <= want[s] + 1e-6
    assert len(rows) == len(words)


def test_a_source_that_one_document_dominates(spark):
    """The gap of each source is smaller than any document of it that could still be drawn; rows that repeat are taken together."""
    rows = [(i, f"s{k}", "w " * (60 + i % 90)) for k in range(8) for i in range(1000 * k, 1000 * k + 120)]
    rows += [(1000 * k + 999, f"s{k}", "w " * 12_000) for k in range(8)] + [(1000 * k + 998, f"s{k}", "w " * 7) for k in range(8)] * 3
    rows += [(10_000, "z", "w " * 90_000)]
    taken, target, n = defaultdict(int), {}, defaultdict(int)
    got = mix_sources(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), weights=(1,) * 8 + (30,)).collect()
    repeats = defaultdict(set)
    for r in got:
        taken[r["source"]] += r["_mix"]["taken"]
        target[r["source"]] = r["_mix"]["target"]
        n[r["source"], r["doc_id"]] += r["_mix"]["size"]
        repeats[r["source"], r["doc_id"]].add(r["_mix"]["copies"])
    assert all(len(c) == 1 for c in repeats.values())
    for s in target:
        left = [n[key] for key, c in repeats.items() if key[0] == s and c == {0}]
        assert taken[s] <= target[s] + 1e-6 and (not left or target[s] - taken[s] < min(left))


def test_reruns_agree(spark):
    one, two = (sorted((r["doc_id"], r["taken"]) for r in op1_mix_sources(spark, FOLDER).collect()) for _ in range(2))
    assert one == two


def test_odd_rows(odd_docs, no_docs, all_null):
    rows = mix_sources(odd_docs).collect()
    assert len(rows) == odd_docs.count() and rows[0].asDict().keys() == {*odd_docs.columns, "_mix"}
    assert {r["_mix"]["copies"] for r in rows if not (r["text"] or "").split()} == {0}
    assert sorted(r["_key"] for r in rows) == ["k"] * len(rows)
    assert len({r["_mix"]["copies"] for r in rows if r["doc_id"] == 12}) == 1
    assert mix_sources(no_docs).collect() == []
    assert [r["_mix"]["taken"] for r in mix_sources(all_null).collect()] == [0, 0, 0]
