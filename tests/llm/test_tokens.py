import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfwise.llm.tokens import Encoder, crc_of_ids, op4_token_files, read_tokens, vocabulary, write_tokens
from shelfwise.session import shared_dir
from tests.test_queries import FOLDER

PATH = vocabulary("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True
FAST = Encoder(PATH)


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["word", " ", "  ", "\n", " \n", "\t", "'s", "don't", "x1", "42", "é", "東京", " ", " ", "\x1c", "<|endoftext|>", ".", ",", "a,", "…"]), st.text(max_size=4))))
def test_pieces_give_the_ids_of_the_whole_text(parts):
    text = "".join(parts)
    assert np.frombuffer(FAST.encode([text])[0], "<u4").tolist() == ids(text)


def test_files_hold_all_ids_in_order(spark):
    got = {r["doc_id"]: r for r in op4_token_files(spark, FOLDER).collect()}
    at = 0
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect():
        want = [*ids(r["text"]), 0]
        row = got[r["doc_id"]]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        at += len(want)
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_layout_and_odd_rows(spark, odd_docs, no_docs):
    for encoding, name in (("dictionary", "PLAIN_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")):
        path = shared_dir(spark, "tokens-test")
        write_tokens(odd_docs, path, PATH, meta=("lang", "_at"), encoding=encoding)
        rows = read_tokens(spark, path, ("ids", "meta_lang", "meta__at")).orderBy("start").collect()
        assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in odd_docs.collect()), key=lambda i: (i is None, i or 0))
        assert [r["start"] for r in rows] == np.cumsum([0, *[len(r["ids"]) for r in rows]])[:-1].tolist()
        text = {r["_at"]: r["text"] for r in odd_docs.collect()}
        assert all(r["ids"] == [*ids(text[r["meta__at"]]), 0] for r in rows)
        file = next(f for f in glob.glob(f"{path}/part-*") if pq.ParquetFile(f).metadata.num_rows)
        column = pq.ParquetFile(file).metadata.row_group(0).column(list(pq.ParquetFile(file).schema_arrow.names).index("ids"))
        assert name in column.encodings and column.has_column_index
    path = shared_dir(spark, "tokens-test")
    write_tokens(no_docs, path, PATH)
    assert crc_of_ids(read_tokens(spark, path)).collect() == []


def test_selective_read_has_no_ids(spark, odd_docs):
    path = shared_dir(spark, "tokens-test")
    write_tokens(odd_docs, path, PATH, meta=("lang",))
    plan = read_tokens(spark, path, ("meta_lang",))._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.replace("doc_ids", "")
