"""The corpus pipeline: five stages over documents, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import stage
from shelfwise.llm.fertility import labels_of, production
from shelfwise.llm.jaccard import jaccard_components
from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.packing import pack, token_pieces
from shelfwise.llm.suffix import suffix_dedup
from shelfwise.llm.tokens import vocabulary

#: Longest sequence of the packed corpus, in tokens.
CAPACITY = 2048
#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def _columns(docs: DataFrame, row: str, text) -> list:
    """The columns of ``docs`` in their order, from a struct of the others and a text."""
    return [text.alias("text") if c == "text" else F.col(f"{row}.`{c}`").alias(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands, which are fitted on the folder's labelled rows; those without text go.

    Defined cases: a folder without labels has the fixed bands; null and empty texts go; very long texts are judged whole; repeated rows share a
    verdict; null languages have their script's bands; no rows give none.
    """
    return production(docs, labels_of(spark, sf_dir)).where("_quality.kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component by five-word shingles and a Jaccard similarity of 0.8, that with the smallest id.

    Defined cases: documents without words, null texts among them, are all kept; of rows that repeat id and text one is kept; null ids come
    last; very long texts are compared whole; no rows give none.
    """
    found = jaccard_components(docs, size=5, num=80, den=100)
    return found.where("is_first").select(*_columns(docs, "_row", F.col("_text")))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of passages that occur earlier.

    What is left of a character whose bytes were cut apart is dropped; documents of which nothing is left go.

    Defined cases: null and empty texts stay as they are; of rows that repeat id and text one has the passage; very long texts are searched whole; no
    rows give none.
    """
    cut = suffix_dedup(docs, as_text=True).where("n_removed < n_bytes or n_bytes = 0")
    return cut.select(*_columns(docs, "_row", F.coalesce("kept", "_text")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a document taken twice is there twice, one not taken is not there.

    Defined cases: a null source is one of its own; null and empty texts have no words and are never taken; rows that repeat id and text are taken together; no rows give none.
    """
    mixed = mix_sources(docs).where("_mix.copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("_mix.copies"))).alias("_copy")
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns], copies).drop("_copy")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences.

    Defined cases: null and empty texts are a piece of one token; very long texts are cut; repeated rows have pieces each; no rows give none.
    """
    return pack(token_pieces(docs, vocabulary("byte_bpe_50k.json"), CAPACITY), CAPACITY)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", mixture),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again as the next one's input.

    Columns beside those of documents pass through all stages but the last, whatever their names; an empty table gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, "corpus-" + name.replace(" ", "-"))
    return docs
