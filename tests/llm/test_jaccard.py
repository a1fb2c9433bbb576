import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm.jaccard import INDEX, PROBE, band_starts, components, jaccard_components, keys_of, op9_jaccard_join, segments_of, shingles_of
from shelfwise.llm.wordhash import mix, shingle_sets, word_hashes
from tests.llm.conftest import prose
from tests.test_queries import FOLDER


def brute(rows, size, num, den=100):
    """(doc_id, set size, smallest reachable id) over all pairs."""
    sets = [shingles_of((t or "").encode(), size) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                top[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


def test_all_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op9_jaccard_join(spark, FOLDER).collect())) == brute(docs, 4, 85)


def test_families_of_copies(spark):
    r, rows = random.Random(11), []
    for f in range(6):
        base = prose(500 + f, r.choice([8, 12, 30, 80, 300])).split()
        for _ in range(25):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 20))):
                words[r.randrange(len(words))] = f"w{r.randint(0, 9)}"
            rows.append((len(rows), " ".join(words[r.randint(0, 1) :])))
    # A passage in many texts, alone not enough for a link.
    shared = prose(900, 50)
    rows += [(1000 + i, shared + " " + prose(6000 + i, r.randint(5, 40))) for i in range(60)]
    rows += [(2000 + i, rows[i * 7][1]) for i in range(20)] + [(3000, ""), (3001, None), (3002, "one"), (3003, "ONE"), (3004, "one two three"), (3005, " one\ttwo\nthree ")]
    for size, num in ((4, 85), (5, 80)):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = jaccard_components(docs, size, num).select("_row.doc_id", "n_shingles", "component_id", "is_first").collect()
        assert sorted(tuple(x)[:3] for x in got) == brute(rows, size, num)
        firsts = [x for x in got if x["is_first"]]
        assert len(firsts) == len({x["component_id"] for x in got}) and all(x["doc_id"] == x["component_id"] for x in firsts)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([(85, 100), (80, 100), (50, 100)]))
def test_linked_sets_share_a_key(n, seed, threshold):
    """For any pair within the bound the larger set's probes meet the smaller one's index."""
    num, den = threshold
    r = random.Random(seed)
    one = [r.getrandbits(64) for _ in range(n)]
    two = list(one)
    while True:
        other = list(two)
        if r.random() < 0.5 and len(other) > 1:
            other.pop(r.randrange(len(other)))
        else:
            other.append(r.getrandbits(64))
        both = len(set(one) & set(other))
        if den * both < num * (len(one) + len(other) - both):
            break
        two = other
    small, large = sorted((one, two), key=len)
    starts = band_starts(len(large), num, den)
    band, upper = (int(np.searchsorted(starts, len(x), "right")) - 1 for x in (small, large))
    assert upper - band in (0, 1)
    m = segments_of(starts[band + 1] - 1, num, den)
    index, kinds = keys_of(np.unique(np.array(small, "uint64")), band, m, INDEX | PROBE)
    probes, kinds2 = keys_of(np.unique(np.array(large, "uint64")), band, m, (INDEX | PROBE) if upper == band else PROBE)
    assert set(index[(kinds & INDEX) > 0].tolist()) & set(probes[(kinds2 & PROBE) > 0].tolist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB \t\n\x0b\x1cé", max_size=30), min_size=1, max_size=6))
def test_word_hashes(texts):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), "uint8")
    found = [(h, i + k) for i, _, hashes, text in word_hashes(data, offsets) for h, k in zip(hashes.tolist(), text.tolist(), strict=True)]
    want = [(w, i) for i, t in enumerate(raw) for w in t.lower().split()]
    assert [k for _, k in found] == [k for _, k in want]
    names = {}
    assert all(names.setdefault(w, h) == h for (w, _), (h, _) in zip(want, found, strict=True)) and len(set(names.values())) == len(names)
    sizes = [len(s) for s in shingle_sets(data, offsets, 3)]
    assert sizes == [len(shingles_of(t, 3)) for t in raw]


def test_a_text_longer_than_a_stretch():
    raw = (prose(3, 300_000) + " " + "z" * 1_200_000 + " end").encode()
    sets = list(shingle_sets(np.frombuffer(raw, "uint8"), np.array([0, len(raw)]), 5))
    assert len(sets) == 1 and len(sets[0]) == len(shingles_of(raw, 5))


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(300, 360)] + [(0, i) for i in range(1, 50)] + [(r.randrange(400, 500), r.randrange(400, 500)) for _ in range(90)]
    top = list(range(600))
    for _ in range(200):
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    got = {x["_v"]: x["_c"] for x in components(spark.createDataFrame(edges, "_u bigint, _v bigint")).collect()}
    assert got == {v: top[v] for e in edges for v in e}
    assert mix(np.arange(5, dtype="uint64")).tolist() != list(range(5))


def test_odd_rows(odd_docs, no_docs, all_null):
    rows = jaccard_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    comp = {}
    for r in rows:
        comp.setdefault(r["_row"]["doc_id"], []).append((r["component_id"], r["is_first"]))
    assert comp[3] == [(2, False)] and comp[4] == [(2, False)] and comp[2] == [(2, True)] and comp[5] == [(5, True)]
    assert sorted(f for c, f in comp[8]) == [False, False, True] and {c for c, _ in comp[8]} == {8}
    assert sorted(f for _, f in comp[12]) == [False, True]
    assert jaccard_components(no_docs).collect() == []
    assert [r["component_id"] for r in jaccard_components(all_null).collect()] == [None] * 3
