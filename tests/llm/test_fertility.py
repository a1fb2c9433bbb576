import math
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shelfwise.llm.fertility import LOSS, MEASURES, bands_of, fit_bands, labels_of, op6_fertility, production, repeated_lines, repeated_words
from shelfwise.llm.tokens import vocabulary
from tests.test_queries import FOLDER


def base_figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside |= {i, i + 1, i + 2}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside), n < 50 or 100 * len(inside) > 50 * n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=30), max_size=4))
def test_repeated_words(texts):
    codes = np.array([ord(w) for t in texts for w in t], "int64")
    got = repeated_words(codes, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype("int64"))
    assert got.tolist() == [base_figures(" ".join(t))[4] for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab \n\t\x0b", max_size=20), max_size=4))
def test_repeated_lines(texts):
    assert repeated_lines(pa.array(texts, pa.string())).tolist() == [base_figures(t)[3] for t in texts]


def test_figures_and_verdicts_of_all_documents(spark):
    """Fertility word by word, bands from the labelled rows, and the verdict, each found again."""
    pieces, pairs = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model")), Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    pairs.encode_special_tokens = True
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bands = fit_bands(docs, labels_of(spark, FOLDER), vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json"), least=5)
    got = {r["doc_id"]: r for r in production(docs, labels_of(spark, FOLDER)).select("doc_id", "lang", "text", "_quality.*").collect()}
    for r in got.values():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        ids = [i for w in words for i in pieces.encode(w)]
        n, chars = max(len(words), 1), sum(map(len, words))
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in Counter(ids).values())
        second = sum(len(e.ids) for e in pairs.encode_batch([" " + w for w in words], add_special_tokens=False))
        want = (len(ids) / n, chars / max(len(ids), 1), chars / max(second, 1), sum(map(pieces.is_byte, ids)) / max(len(ids), 1), entropy)
        assert (r["tokens_per_word"], r["chars_per_token"], r["chars_per_byte_token"], r["byte_share"], r["token_entropy"]) == pytest.approx(want)
        assert r["kept"] == (not r["failed"]) and r["base_failed"] == ("base" in r["failed"])
    assert bands
    # Each fitted bound loses no more good rows than the share allows, but for whole rows.
    labels = {r["doc_id"]: r["quality"] for r in labels_of(spark, FOLDER).collect()}
    for lang, own in bands.items():
        good = [r for r in got.values() if r["lang"] == lang and labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
        for m in MEASURES:
            low, high = own[m]
            assert sum(r[m] < low for r in good) <= 1 + LOSS * len(good) and sum(r[m] > high for r in good) <= 1 + LOSS * len(good)


def test_base_figures_of_all_documents(spark):
    got = {r["doc_id"]: r for r in op6_fertility(spark, FOLDER).collect()}
    for d in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        r = got[d["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base_figures(d["text"])
        assert not (r["base_failed"] and r["kept"])


def test_clean_documents_stay_and_junk_goes(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = op6_fertility(spark, FOLDER).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.97 * len(good) and (not bad or sum(bad) < 0.7 * len(bad))


def test_held_out_rows(spark):
    """Bands fitted on half of the larger table's labelled rows, judged on the other half."""
    folder = f"{os.path.dirname(FOLDER)}/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), labels_of(spark, folder)
    rows = production(docs, labels.where("doc_id % 2 = 0")).where("not _quality.base_failed").join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "_quality.kept").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert len(bad) > 100 and sum(bad) <= 0.25 * len(bad) and sum(good) >= 0.985 * len(good)


@pytest.mark.parametrize(("text", "kept"), [
    ("Der Ausschuss hat gestern über den Vorschlag beraten und ihn ohne Gegenstimme angenommen. Nach einer kurzen Pause sprach die Leiterin "
     "der Bibliothek von neuen Büchern, alten Karten und einem Brief, den jemand im Keller gefunden hatte. Viele Gäste blieben bis zum Abend, "
     "tranken Tee und redeten leise miteinander; draußen fiel der erste Schnee auf leere Straßen, während oben noch Licht brannte.", True),
    (" ".join(f"xq{i}#$%zzk&&&vvw***" for i in range(80)), False),
    (" ".join("ab"[i % 2] for i in range(200)), False),
])
def test_bands(spark, text, kept):
    docs = spark.createDataFrame([(1, text, None)], "doc_id bigint, text string, lang string")
    assert production(docs).select("_quality.kept").first()[0] is kept


def test_odd_rows(odd_docs, no_docs, all_null):
    rows = production(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {*rows[0].asDict()} == {*odd_docs.columns, "_quality"}
    assert all(not r["_quality"]["kept"] for r in rows if not (r["text"] or "").split())
    assert production(no_docs).collect() == []
    assert [r["_quality"]["n_words"] for r in production(all_null).collect()] == [0, 0, 0]


def test_bands_come_from_every_good_row(spark):
    """More good rows than any sample took, the extreme ones few: bounds are the exact percentiles of all of them."""
    n = 40_001
    v = "cast(case when id % 1000 = 7 then id else id % 10 end as double)"
    figures = ", ".join(f"'{m}', {v}" for m in MEASURES)
    rows = spark.range(n).selectExpr("id as _id", "if(id % 4 = 0, 'de', 'en') as lang", f"named_struct('base_failed', id % 5 = 0, 'script', 'latin', {figures}) as _quality")
    bands = bands_of(rows)
    assert set(bands) == {"de", "en"}
    for lang, own in bands.items():
        mine = [float(i if i % 1000 == 7 else i % 10) for i in range(n) if i % 5 and ("de" if i % 4 == 0 else "en") == lang]
        assert own["tokens_per_word"] == own["chars_per_token"] == pytest.approx(tuple(np.quantile(mine, [LOSS, 1 - LOSS])))
    assert bands_of(rows, least=n) == {}
