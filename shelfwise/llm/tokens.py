"""Token ids of documents in Parquet files made for selective reads."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, query
from shelfwise.llm.parts import Known, chunks, encode_parts, ranges, split, starts
from shelfwise.session import shared_dir

#: Id that ends each document.
END = 0
def vocabulary(name: str) -> str:
    """Path of a public vocabulary that is installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts by a vocabulary of the tokenizers library, each part of a batch encoded once.

    A byte-level vocabulary cuts text before a space that begins a word, so the text's ids are the
    ids of its parts (``parts.split``), of which a batch has few distinct ones. Vocabularies of
    another kind encode whole texts. Parts and their ids are kept for the next batches up to a bound (``Known``), which saves time only.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        # Names of special tokens in a text are ordinary text.
        self.full.encode_special_tokens = True
        rules = json.loads(self.full.to_str())
        cut = rules["pre_tokenizer"] or {}
        self.by_word = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not rules["normalizer"]
        self.pieces, self.model = regex.compile(PATTERN), self.full.model
        # The letters of the byte-level alphabet, in the order of the bytes: printable Latin-1 for itself, the rest from code point 256 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = (b for b in range(256) if b not in plain)
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.names = [self.full.id_to_token(i) or "" for i in range(self.full.get_vocab_size())]
        self.lead = np.array([t.startswith(self.letters[32]) for t in self.names])
        self.known = Known()

    def count(self, text: str) -> int:
        """Number of ids of a short text; nothing is kept."""
        if not self.by_word:
            return len(self.full.encode(text, add_special_tokens=False).ids)
        pieces = [text] if text[1:].isalpha() else self.pieces.findall(text)
        return sum(len(self.model.tokenize(p.encode("utf-8", "replace").decode("latin-1").translate(self.letters))) for p in pieces)

    def whole(self, texts: list[str]) -> list:
        """Ids of each text, by the library on whole texts."""
        from numpy import array

        return [array(e.ids, "int64") for e in self.full.encode_batch_fast(texts, add_special_tokens=False)]

    def spaced(self, words) -> tuple:
        """Ids of distinct parts after a space, flat, and their offsets; those of earlier batches are looked up."""
        return self.known.of(words, lambda some: encode_parts(some, lambda joined: self.whole([" " + t for t in joined]), lambda p: self.whole([" " + p])[0], self.lead))

    def batch(self, texts) -> tuple:
        """Ids of an array of strings, flat, and their offsets; null is empty."""
        import numpy as np

        if not self.by_word:
            each = self.whole([t or "" for t in texts.to_pylist()])
            return np.concatenate([*each, np.zeros(0, "int64")]).astype("uint32"), starts([len(x) for x in each])
        parts = split(texts)
        ids, at = self.spaced(parts.distinct)
        # A text's first part has no space before it.
        codes, some = parts.codes.copy(), np.diff(parts.offsets) > 0
        which, codes[parts.offsets[:-1][some]] = np.unique(codes[parts.offsets[:-1][some]], return_inverse=True)
        codes[parts.offsets[:-1][some]] += len(parts.distinct)
        first = self.whole(parts.distinct.take(which).to_pylist())
        sizes = np.concatenate([np.diff(at), np.array([len(x) for x in first], "int64")])
        ids = np.concatenate([ids, *first]).astype("uint32")
        each = sizes[codes]
        return ids[ranges(starts(sizes)[codes], each)], starts(each)[parts.offsets]

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Per text, its ids as little-endian unsigned 32-bit integers; null is empty."""
        import pyarrow as pa

        ids, at = self.batch(pa.array(texts, pa.string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


def release() -> None:
    """Give the memory of vocabularies and batches back: a worker is reused by later stages, which need it."""
    import ctypes
    import gc

    import pyarrow as pa

    encoder.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ended(texts, path: str) -> tuple:
    """Ids of an array of strings, each text's followed by the end id, flat, and their offsets."""
    import numpy as np

    ids, at = encoder(path).batch(texts)
    ends = at + np.arange(len(at))
    out = np.full(ends[-1], END, ids.dtype)
    own = np.ones(len(out), bool)
    own[ends[1:] - 1] = False
    out[own] = ids
    return out, ends


#: Parquet settings of the id column by name of its encoding.
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(4 << 20)},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"},
}


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta: Sequence[str] = (),
    encoding: str = "dictionary",
    row_group_bytes: int = 16 << 20,
    page_rows: int = 500,
) -> None:
    """Write the ids of each whole text, ended by id 0, in ascending id order.

    Columns: ``doc_id``, ``part`` and ``at`` (file part, ids before the document in it), ``n_tokens``,
    ``ids`` (list), and the ``meta`` columns as ``meta_<name>``. Documents are range-partitioned by
    id, so min/max of row groups and pages (Parquet's page index) find the pages of an id range; a
    reader of ``n_tokens`` or of metadata reads no ids. ``encoding``: ``dictionary`` (16 bits an id
    here) or ``delta``. ``row_group_bytes`` and ``page_rows`` bound what a selective read touches.

    Defined cases: null text is empty (the end id alone); null ids come last, repeated ids are
    ordered by a hash of their text; equal rows are written as often as they occur; no rows give files
    without rows; other columns are left out, and cannot clash.
    """
    import pyarrow as pa

    order = [F.col("doc_id").asc_nulls_last(), F.col("_order")]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *[F.col(f"`{m}`").alias(f"meta_{m}") for m in meta])
    rows = rows.withColumn("_order", F.xxhash64("_text")).repartitionByRange(*order).sortWithinPartitions(*order).drop("_order")
    kept = ["doc_id", *[f"meta_{m}" for m in meta]]

    def encode(batches):
        import numpy as np
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text"))
            for i, n in chunks(texts):
                some = batch.slice(i, n)
                ids, ends = ended(texts.slice(i, n), tokenizer)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(ids.astype("int32")))
                arrays = [some.column(some.schema.get_field_index(k)) for k in kept]
                arrays += [pa.array(np.full(n, part, "int32")), pa.array(at + ends[:-1]), pa.array(np.diff(ends)), lists]
                at += int(ends[-1])
                out = pa.RecordBatch.from_arrays(arrays, names=[*kept, "part", "at", "n_tokens", "ids"])
                yield from (out.slice(k, 256) for k in range(0, n, 256))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema.fields)
    coded = rows.mapInArrow(encode, f"{kinds}, part int, at bigint, n_tokens bigint, ids array<int>")
    writer = coded.write.option("compression", "zstd").option("parquet.block.size", str(row_group_bytes))
    writer = writer.option("parquet.page.row.count.limit", str(page_rows)).option("parquet.page.size", str(256 << 10))
    for key, value in ENCODINGS[encoding].items():
        writer = writer.option(key, value)
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: Sequence[str] = ("ids",)) -> DataFrame:
    """Documents of token files with ``start``, the ids of all documents before each, and the wanted columns.

    Only ``n_tokens`` is read for the starts: sums per file part, then a running sum over the parts. That
    is one row per task that wrote, so it is broadcast, and the ids stay where they are read.
    """
    files = spark.read.parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    wanted = [c for c in columns if c not in ("doc_id", "n_tokens")]
    return files.join(F.broadcast(parts), "part").select("doc_id", (F.col("_base") + F.col("at")).alias("start"), "n_tokens", *wanted)


def crc_of_ids(tokens: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``, the CRC of the ids as little-endian unsigned 32-bit integers."""
    import pyarrow as pa

    kept = [f for f in tokens.schema.fields if f.name != "ids"]

    def sums(batches):
        import numpy as np

        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            values, ends = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(crc, "int64")], names=[*[f.name for f in kept], "ids_crc32"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return tokens.mapInArrow(sums, f"{kinds}, ids_crc32 bigint")


@query("op4_token_files")
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as token files, and what is read back."""
    path = shared_dir(spark, "tokens")
    write_tokens(documents(spark, folder), path, vocabulary("byte_bpe_50k.json"), meta=("lang", "source"))
    return crc_of_ids(read_tokens(spark, path, ("ids", "meta_lang", "meta_source")))
