import hashlib
from collections import Counter

import pandas as pd
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shelfwise.llm.alignment import align, align_parts, op13_align_tokens, overlaps
from shelfwise.llm.parts import split
from shelfwise.llm.tokens import encoder, vocabulary
from tests.test_queries import FOLDER

PAIRS, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
A, B = Tokenizer.from_file(PAIRS), SentencePieceProcessor(model_file=PIECES)
A.encode_special_tokens = True
LETTERS = {c: b for b, c in encoder(PAIRS).letters.items()}


def tokens(text):
    """(id, bytes) by both vocabularies on the whole text; none where the bytes differ."""
    if not text:
        return [], []
    a = [(e, bytes(LETTERS[c] for c in A.id_to_token(e))) for e in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        name = B.id_to_piece(i)
        b.append((i, bytes([int(name[3:-1], 16)]) if B.is_byte(i) else name.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def spans(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(texts):
    """All figures by walking along the bytes of each text."""
    out, total = [], Counter()
    for text in texts:
        a, b = map(spans, tokens(text))
        left, right = ({at: i for i, (_, low, high) in enumerate(side) for at in range(low, high)} for side in (a, b))
        links = [(a[i][0], b[j][0]) for i, j in sorted({(left[at], right[at]) for at in left})]
        total.update(links)
        groups, x, y = [], [], []
        for at in range(1, len(left) + 1):
            ends = [[i for i, _, high in side[k[at - 1] : k[at - 1] + 1] if high == at] for side, k in ((a, left), (b, right))]
            x, y = x + ends[0], y + ends[1]
            if ends[0] and ends[1]:
                groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
                x, y = [], []
        out.append((len(a), len(b), groups, links))
    most = Counter()
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    return [
        (na, nb, len(groups), len(links), sum(total[p] == most[p[1]] for p in links), sum(total[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if na else "")
        for na, nb, groups, links in out
    ]


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    None, "", " ", "a", " a", "a ", "a  b", "a▁b", "▁", "\n", "x\n y", "don't stop", "naïve café 東京 😀", "<|endoftext|> <s> </s> <0x0A>", "　x y", "a  b",
    "tab\tend \x1c x", "\u0000 nul", "word word word", "x" * 3000, "é é", "1,000.50 €", "… — “q”",
]


@settings(max_examples=250, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["word", " ", "  ", "\n", " \n", "\t", "'s", "don't", "x1", "42", "é", "東京", "　", " ", "\x1c", "<|endoftext|>", "<s>", ".", "▁", "…"]), st.text(max_size=4))))
def test_parts_give_the_tokens_of_the_whole_text(parts):
    text = "".join(parts)
    a, b = tokens(text)
    cut = split(pa.array([text]))
    by = align_parts(cut.distinct, PAIRS, PIECES)
    got = "".join(by["text"][cut.codes])[:-1]
    if any(by["bad"][cut.codes]):
        assert (a, b) == ([], [])
    else:
        left, right = [], []
        for group in got.split(";") if got else []:
            x, _, y = group.partition("|")
            left += x.split(",")
            right += y.split(",")
        assert (left, right) == ([str(i) for i, _ in a], [str(i) for i, _ in b])


def test_overlaps_in_both_directions():
    a = pd.DataFrame({"doc": [0, 0, 1, 1], "start": [0, 4, 6, 7]})
    b = pd.DataFrame({"doc": [0, 0, 0, 1], "start": [0, 2, 5, 6]})
    assert sorted(map(tuple, overlaps(a, b)[["a", "b"]].to_numpy().tolist())) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 3), (3, 3)]


def test_odd_texts_and_counts(spark):
    rows = [(i, t) for i, t in enumerate(ODD * 2)] + [(None, "word again"), (3, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got, counts = align(docs, PAIRS, PIECES)
    want = brute([t for _, t in rows])
    assert sorted((str(r["doc_id"]), *[r[k] for k in FIGURES]) for r in got.collect()) == sorted((str(i), *w) for (i, _), w in zip(rows, want, strict=True))
    assert counts.agg({"count": "sum"}).collect()[0][0] == sum(w[3] for w in want)


def test_all_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = {d["doc_id"]: w for d, w in zip(docs, brute([d["text"] for d in docs]), strict=True)}
    got = {r["doc_id"]: tuple(r[k] for k in FIGURES) for r in op13_align_tokens(spark, FOLDER).collect()}
    assert got == want


def test_odd_rows(spark, odd_docs, no_docs, all_null):
    assert align(no_docs, PAIRS, PIECES)[0].collect() == []
    assert [tuple(r) for r in align(all_null, PAIRS, PIECES)[0].collect()] == [(None, 0, 0, 0, 0, 0, 0, "")] * 3
    rows = align(odd_docs, PAIRS, PIECES)[0].collect()
    assert len(rows) == odd_docs.count() and len({tuple(r) for r in rows if r["doc_id"] == 12}) == 1
