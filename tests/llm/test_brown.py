import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import brown
from shelfwise.llm.brown import CLASSES, EXCHANGE, exchange, op8_brown_scores, score_documents
from tests.test_queries import FOLDER


def base_scores(rows):
    counts, docs = Counter(), []
    for i, text in rows:
        words = [*(text or "").encode().lower().split(), None]
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
        docs.append((i, held, words))
        if not held:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return n, [(i, held, len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for i, held, w in docs]


@pytest.fixture(scope="module")
def scored(spark):
    return {r["doc_id"]: r for r in op8_brown_scores(spark, FOLDER).collect()}


def test_counts_and_base(spark, scored):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    total, want = base_scores(rows)
    assert len(scored) == len(rows)
    for i, held, tokens, known, base in want:
        r = scored[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, total)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) + 1e-9


def test_model_beats_words_alone_on_held_out_texts(scored):
    rows = [r for r in scored.values() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) and all(r["score"] < 0 for r in rows)


def test_exchange_finds_the_best_class():
    """The gain found for each class equals the likelihood's change when it is computed in full."""
    r = np.random.default_rng(4)
    table = r.integers(0, 30, (CLASSES, CLASSES)).astype(float)
    after, before = r.integers(0, 4, CLASSES).astype(float), r.integers(0, 4, CLASSES).astype(float)
    current, own = 7, 3.0
    table[current] += after
    table[:, current] += before
    table[current, current] += own

    def moved(to):
        t = table.copy()
        for k, sign in ((current, -1), (to, 1)):
            t[k] += sign * after
            t[:, k] += sign * before
            t[k, k] += sign * own
        return t

    def likelihood(t):
        f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
        return f(t) - f(t.sum(axis=0)) - f(t.sum(axis=1))

    best = max(range(EXCHANGE), key=lambda k: likelihood(moved(k)))
    mine = table.copy()
    got = exchange(after, before, own, current, mine)
    assert likelihood(moved(got)) == pytest.approx(likelihood(moved(best)))
    assert np.allclose(mine, moved(got))


def test_probabilities_add_up(spark, monkeypatch):
    """Over the words of a small corpus and one unseen word per class, the model's next-word probabilities sum to at most 1."""
    docs = spark.createDataFrame([(i, " ".join("abcde"[(i * j) % 5] for j in range(6))) for i in range(1, 40)], "doc_id bigint, text string")
    one = spark.createDataFrame([(1000 + k, w) for k, w in enumerate("abcde")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r["score"] for r in score_documents(docs.union(one)).collect()}
    assert 0 < sum(10 ** rows[1000 + k] for k in range(5)) < 1


def test_odd_rows(odd_docs, no_docs, all_null):
    rows = score_documents(odd_docs).collect()
    total, want = base_scores([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    key = lambda x: (str(x[0]), x[2], round(x[4], 4))
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["base_score"]) for r in rows), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6 * abs(b[4]) + 1e-9
    assert score_documents(no_docs).collect() == []
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in score_documents(all_null).collect()] == [(1, 0, 0)] * 3
    assert brown.ending(b"a") == zlib.crc32(b"a") % brown.ENDINGS


def test_choose_finds_the_best_class():
    """Classes chosen for many words at once on one table are those with the greatest likelihood, computed in full."""
    r = np.random.default_rng(5)
    count = 12
    after, before = (np.where(r.random((count, CLASSES)) < 0.1, r.integers(1, 30, (count, CLASSES)), 0) for _ in range(2))
    own, current = np.where(r.random(count) < 0.3, 4, 0), r.integers(0, EXCHANGE, count)
    after[:4, current[:4]] += 2
    before[2:6, current[2:6]] += 3
    table = r.integers(0, 6, (CLASSES, CLASSES)).astype(float)
    for a, b, s, c in zip(after, before, own, current, strict=True):
        table[c] += a
        table[:, c] += b
        table[c, c] += s

    def likelihood(w, to):
        t = table.copy()
        for k, sign in ((current[w], -1), (to, 1)):
            t[k] += sign * after[w]
            t[:, k] += sign * before[w]
            t[k, k] += sign * own[w]
        f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
        return f(t) - f(t.sum(axis=0)) - f(t.sum(axis=1))

    all_pairs = np.hstack([after, before, own[:, None]])
    word, kind = np.nonzero(all_pairs)
    got = brown.choose(word, kind, all_pairs[word, kind], current, table)
    assert list(got) == [max(range(EXCHANGE), key=lambda k: likelihood(w, k)) for w in range(count)]


@pytest.fixture(scope="module")
def sentences(spark):
    """Texts of `the noun verb`, with more nouns and verbs than words move in rounds, all of one ending; two held-out texts of words seen once."""
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    pairs = [*[(i, i * 7 % 2100) for i in range(2100)] * 2, *((i, i % 900) for i in range(2100, 2400)), *((i % 900, i) for i in range(2100, 2400))]
    texts = [" ".join(f"the n{a:05d}xx v{b:05d}xx" for a, b in pairs[i : i + 50]) for i in range(0, len(pairs), 50)]
    rows = list(zip((i for i in range(10_000) if not held(i)), texts, strict=False))
    ids = [i for i in range(20_000, 21_000) if held(i)][:2]
    rows += zip(ids, ["the n02200xx v02300xx", "the v02300xx n02200xx"], strict=True)
    return spark.createDataFrame(rows, "doc_id bigint, text string"), ids


def scores(docs):
    return {r["doc_id"]: r["score"] for r in score_documents(docs).collect()}


def test_rare_words_have_learned_classes(sentences):
    """Beyond the words that move in rounds, classes come from a word's neighbours, not from its ending."""
    docs, (right, wrong) = sentences
    found = scores(docs)
    assert found[right] > found[wrong] + 1


def test_joined_words_score_like_held_ones(sentences, monkeypatch):
    docs, _ = sentences
    want = scores(docs)
    monkeypatch.setattr(brown, "HEAD", brown.CLUSTERED + 204)
    got = scores(docs)
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-6) for i in want)


BLANKS_AND_BYTES = [None, b"", b" ", b"a", b"\x00 b\xff\xfe A\x85B\xa0", b"  x  y ", b"\x1c a\x1db \x0b\x0cZ", bytes(range(256)), b"a a b a a", None, b"\xc3\x84 zz\nzz\t"]


@pytest.mark.parametrize("stretch", [1 << 21, 40, 5])
def test_pieces_are_the_words_of_texts(monkeypatch, stretch):
    """Words found for many texts at once are those of each text on its own, wherever texts are cut; so are their endings."""
    monkeypatch.setattr(brown, "STRETCH", stretch)
    texts = pa.array([b"cut", *BLANKS_AND_BYTES], "binary").slice(1)
    got, text = [], []
    for words, sizes, ended in brown.pieces(texts):
        found = words.view(pa.binary()).to_pylist()
        assert list(brown.endings(words)) == [brown.ending(w) for w in found]
        for i, size in enumerate(sizes):
            text, found = text + found[:size], found[size:]
            if ended or i < len(sizes) - 1:
                got.append(text)
                text = []
    assert got == [(raw or b"").lower().split() for raw in BLANKS_AND_BYTES]


@pytest.mark.parametrize(("stretch", "moving"), [(1 << 21, 600_000), (5, 3)])
def test_contexts_count_every_pair(monkeypatch, stretch, moving):
    """Pairs of words that are not clustered, compared with a plain count, also where a task gives sums between two words."""
    monkeypatch.setattr(brown, "STRETCH", stretch)
    monkeypatch.setattr(brown, "MOVING", moving)
    classes = [i % brown.FIRST for i in range(brown.CLUSTERED)] + [brown.FIRST + i for i in range(brown.ENDINGS)] + [brown.END_CLASS]
    known, want, got = [b"a", b"x"], Counter(), Counter()
    for raw in BLANKS_AND_BYTES:
        line = [None, *(raw or b"").lower().split(), None]
        kinds = [brown.END_CLASS if w is None else classes[known.index(w)] if w in known else brown.FIRST + brown.ending(w) for w in line]
        for i in range(len(line) - 1):
            far = [w is not None and w not in known for w in line[i : i + 2]]
            if all(far) and line[i] == line[i + 1]:
                want[line[i], 2 * CLASSES] += 1
                continue
            if far[0]:
                want[line[i], kinds[i + 1]] += 1
            if far[1]:
                want[line[i + 1], CLASSES + kinds[i]] += 1
    batch = pa.RecordBatch.from_arrays([pa.array(BLANKS_AND_BYTES, "binary")], names=["_raw"])
    for rows in brown._contexts(brown._word_array(known), classes)(iter([batch])):
        for word, pairs in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            for pair in np.frombuffer(pairs, "int32").tolist():
                got[word, pair % brown.PAIRS] += pair // brown.PAIRS
    assert got == want
