import hashlib
import random
import time
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm.periodic import digests, op12_periodic_runs, periodic_runs, runs_of_batch, scan, segments_of
from shelfwise.llm.parts import word_codes
from tests.test_queries import FOLDER


def brute(words):
    """All runs by comparing every word with the word at every lag."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def runs(words):
    codes = np.array([ord(w) for w in words], "int64")
    return runs_of_batch(codes, np.array([0, len(codes)]))[0]


PIECE = st.one_of(
    st.tuples(st.text("abc", min_size=1, max_size=30), st.integers(1, 12)).map(lambda x: x[0] * x[1]),
    st.tuples(st.text("abcdefgh", min_size=1, max_size=60), st.integers(2, 5)).map(lambda x: x[0] * x[1]),
    st.text("abcdefghijklmnop", max_size=40),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECE, max_size=6).map("".join))
def test_same_runs_as_brute_force(text):
    want = brute(text)
    assert runs(text) == want
    if text:
        assert scan(np.array([ord(c) for c in text])) == want


def test_long_periods_and_nested_runs():
    r = random.Random(1)
    for _ in range(60):
        root = [r.randrange(40) for _ in range(r.randint(1, 400))]
        if r.random() < 0.5:
            low = r.randrange(len(root))
            root[low : low + 30] = [root[low]] * 30
        words = [r.randrange(40) for _ in range(r.randint(0, 90))] + root * r.randint(2, 4) + root[: r.randint(0, len(root))] + [r.randrange(40) for _ in range(90)]
        got = runs_of_batch(np.array(words), np.array([0, len(words)]))[0]
        assert got == brute(words)


def test_splitting_goes_on_until_nothing_changes():
    # Each round of splitting makes further words rare: x three times, but never thrice within a part.
    words = list("x" * 2 + "ab" * 3 + "q" + "x" * 1 + "ab" * 14)
    low, high = segments_of(np.array([ord(w) for w in words]), np.zeros(len(words), "int64"))
    assert [("".join(words[a:b])) for a, b in zip(low, high, strict=True)] == ["ab" * 14]


def test_texts_of_a_batch_do_not_meet():
    codes, at = np.tile([1, 2], 20), np.array([0, 20, 20, 40])
    assert runs_of_batch(codes, at) == [[], [], []]
    assert runs_of_batch(codes, np.array([0, 26, 40])) == [[(0, 26, 2)], []]


def test_long_repetitive_texts_take_little_time():
    r = np.random.default_rng(2)
    root = r.integers(0, 500, 60_000)
    begin = time.perf_counter()
    assert scan(np.tile(root, 4)) == [(0, 240_000, 60_000)]
    assert scan(np.zeros(300_000, "int64")) == [(0, 300_000, 1)]
    phrase = r.integers(0, 500, 12)
    mixed = np.concatenate([np.concatenate([phrase, r.integers(0, 500, int(k))]) for k in r.integers(1, 30, 6000)])
    assert scan(mixed) == []
    assert time.perf_counter() - begin < 60


def test_words_are_cut_at_ascii_blanks():
    codes, distinct, at = word_codes(pa.array(["a\tb\x0bc  a", None, "", " x y", "\x1cé　b"]))
    assert [distinct.to_pylist()[c] for c in codes] == ["a", "b", "c", "a", "x", "y", "\x1cé　b"] and at.tolist() == [0, 4, 4, 4, 6, 7]


def want_row(doc, text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    found = quick([numbers[w] for w in words])
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def quick(words):
    """Brute force over all lags with numpy."""
    words, found = np.array(words), {}
    for q in range(1, len(words) // 3 + 1):
        edge = np.diff(np.concatenate([[0], (words[:-q] == words[q:]).astype("int8"), [0]]))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + q
        for a, b in zip(s[e - s >= max(24, 3 * q)].tolist(), e[e - s >= max(24, 3 * q)].tolist(), strict=True):
            found.setdefault((a, b), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def test_all_documents(spark):
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {r["doc_id"]: tuple(r[k] for k in names) for r in op12_periodic_runs(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and all(got[d["doc_id"]] == want_row(d["doc_id"], d["text"]) for d in docs)
    assert sum(row[1] > 0 for row in got.values()) > len(docs) // 20


def test_odd_rows(spark, odd_docs, no_docs, all_null):
    assert digests(periodic_runs(no_docs)).collect() == []
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in digests(periodic_runs(all_null)).collect()] == [(None, 0, None, None, None, None, empty, empty, 0)] * 3
    rows = periodic_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    again = spark.createDataFrame([(1, "a b " * 40 + "end")], "doc_id long, text string")
    assert [(r["runs"][0][:], r["collapsed"]) for r in periodic_runs(again).collect()] == [((0, 80, 2), "a b end")]
