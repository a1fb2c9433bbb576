"""SimHash fingerprints and their search by permuted block tables; DataFrame operations only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import GAP, documents, query, ranked, row_key, stage, text_table

BITS = 64
#: Two counters of 32 bits in each sum: a text's term weights may add up to four billion.
_LANES = 32
_BOTH = (1 << 32) | 1


def term_weight(term: Column) -> Column:
    """Weight of one occurrence: the term's letters beyond two, at least one; short function words say little."""
    return F.greatest(F.length(term) - 2, F.lit(1)).cast("long")


def fingerprint(texts: DataFrame, keys: list[str], text: str, weight=term_weight) -> DataFrame:
    """``keys`` and ``_fp``: each term (word) hashes to 64 bits and votes with its weight for or against each bit.

    A bit is set when the weights for it are more than half of all. 32 sums of two counters each
    hold the votes; they are added up within the scan's tasks before the shuffle, so that a text costs
    one small row there. A text without words has fingerprint 0; null counts as empty.
    """
    terms = texts.select(*keys, F.explode_outer(F.split(F.col(text), GAP)).alias("_term"))
    terms = terms.withColumn("_w", F.when(F.length("_term") > 0, weight(F.col("_term"))).otherwise(F.lit(0)))
    terms = terms.withColumn("_h", F.xxhash64("_term"))
    votes = [F.sum(F.shiftrightunsigned("_h", j).bitwiseAND(F.lit(_BOTH)) * F.col("_w")).alias(f"_s{j}") for j in range(_LANES)]
    summed = terms.groupBy(*keys).agg(F.sum("_w").alias("_all"), *votes)
    bits = F.lit(0).cast("long")
    for j in range(_LANES):
        low, high = F.col(f"_s{j}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"_s{j}", 32)
        for count, place in ((low, j), (high, j + _LANES)):
            value = (1 << place) if place < 63 else -(1 << 63)
            bits = bits.bitwiseOR(F.when(count * 2 > F.col("_all"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, bits.alias("_fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """Pairs ``_q, _fp`` of distinct fingerprints (queries: ``_q``; index: ``_fp``) at most ``radius`` bits apart, all of them.

    The 64 bits are cut into ``blocks`` blocks. Two fingerprints within the radius agree on all but
    ``radius`` blocks at least, so there is one table for each choice of ``blocks - radius`` blocks,
    keyed by those blocks' bits; a pair is taken from the first table where it agrees.
    """
    if not 0 <= radius < blocks:
        raise ValueError("radius must be below blocks")
    size, more = divmod(BITS, blocks)
    masks, at = [], 0
    for i in range(blocks):
        width = size + (i < more)
        masks.append(((1 << width) - 1) << at)
        at += width
    tables = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(masks[i] for i in chosen)
        tables.append(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("long"))

    def permuted(df: DataFrame, col: str) -> DataFrame:
        df = df.select(col, F.posexplode(F.array(*[F.col(col).bitwiseAND(m) for m in tables])).alias("_table", "_key"))
        return df

    a, b = permuted(queries, "_q"), permuted(index, "_fp")
    apart = F.bit_count(F.col("_q").bitwiseXOR(F.col("_fp")))
    first = F.lit(len(tables))
    for i in reversed(range(len(tables))):
        first = F.when(F.col("_q").bitwiseAND(tables[i]) == F.col("_fp").bitwiseAND(tables[i]), F.lit(i)).otherwise(first)
    match = (a["_table"] == b["_table"]) & (a["_key"] == b["_key"]) & (apart <= radius) & (first == a["_table"])
    return a.join(b, match).select("_q", "_fp", apart.alias("distance"))


def edited_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 4) -> tuple[DataFrame, DataFrame]:
    """(texts with ``_row, doc_id, _text, _n, _edited``; ``_row, _next``: the row that follows in order of id).

    The edited text ends in the first floor(n / share) characters of the next document, after the last
    of the first, instead of its own last ones. Texts are staged once by row key and not moved again:
    order and lengths go through narrow tables, and a document sends its neighbour just the characters
    that it needs.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), row_key(F.col(id_col), text).alias("_row"))
    rows = text_table(rows.withColumn("_n", F.char_length("_text")), "_row", "simhash")
    one = rows.groupBy("_row", "doc_id", "_n").agg(F.count("*").alias("_rows"))
    order = stage(ranked(one, [F.col("doc_id").asc_nulls_last(), F.col("_row")], name="_i", purpose="simhash-order"), "simhash-rows")
    total = order.count()
    after = order.select(F.col("_row").alias("_next"), F.col("_rows").alias("_next_rows"), F.pmod(F.col("_i") - 1, F.lit(max(total, 1))).alias("_i"))
    pairs = stage(order.select("_row", "_n", "_i").join(after, "_i").withColumn("_take", F.floor(F.col("_n") / share).cast("int")), "simhash-pairs")
    # What each document gets from its neighbour; a repeated neighbour sends it once.
    needs = pairs.select(F.col("_next").alias("_from"), F.col("_row").alias("_to"), "_take", "_next_rows")
    sent = rows.select(F.col("_row").alias("_from"), "_text").join(needs, "_from").select("_to", F.substring(F.col("_text"), F.lit(1), F.col("_take")).alias("_tail"), "_take", "_next_rows")
    sent = sent.where("_next_rows = 1").unionByName(sent.where("_next_rows > 1").dropDuplicates(["_to"])).drop("_next_rows")
    sent = stage(sent, "simhash-tails").withColumnRenamed("_to", "_row")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), F.col("_n") - F.col("_take")), F.col("_tail"))
    return rows.join(sent, "_row").select("_row", "doc_id", "_text", "_n", edited.alias("_edited")), pairs.select("_row", "_next")


def simhash_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, blocks: int = 6, queries=None) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with likenesses and the number of near fingerprints.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint`` (16 hexadecimal digits),
    ``near_edited, near_next`` and ``n_near``: for documents that ``queries`` (a condition on doc_id,
    by default ids divisible by 100) picks, how many documents, itself included, lie within
    ``radius`` bits, searched among all; else null.

    Defined cases: null text is empty; an empty text has fingerprint 0; rows that repeat id and text
    are one document for the order, and each gets the same row; null ids come last; no rows give no
    rows; other columns are left out, and cannot clash.
    """
    texts, following = edited_texts(docs, id_col, text_col)
    both = texts.select("_row", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("_text").alias("t")), F.struct(F.lit(1).alias("k"), F.col("_edited").alias("t")))).alias("_x"))
    both = both.select("_row", F.col("_x.k").alias("_kind"), F.col("_x.t").alias("_t"))
    prints = stage(fingerprint(both, ["_row", "_kind"], "_t"), "simhash-prints")
    own = prints.where("_kind = 0").select("_row", "_fp")
    edit = prints.where("_kind = 1").select("_row", F.col("_fp").alias("_efp"))
    follow = following.join(own.toDF("_next", "_nfp"), "_next").select("_row", "_nfp")
    digest = texts.select("_row", "doc_id", F.col("_n").cast("long").alias("n_chars"), F.sha2(F.col("_edited"), 256).alias("edited_sha256"))
    out = stage(digest.join(own, "_row").join(edit, "_row").join(follow, "_row"), "simhash-out")

    picked = queries(F.col("doc_id")) if queries else F.col("doc_id") % 100 == 0
    counts = out.groupBy("_fp").agg(F.count("*").alias("_rows"))
    asked = out.where(picked).select(F.col("_fp").alias("_q")).distinct()
    found = within_radius(asked, counts.select("_fp"), radius, blocks)
    near = stage(found.join(counts, "_fp").groupBy("_q").agg(F.sum("_rows").alias("n_near")), "simhash-near")
    out = out.join(near, out["_fp"] == near["_q"], "left")
    text = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", text(F.col("_fp")).alias("fingerprint"), text(F.col("_efp")).alias("edited_fingerprint"),
        likeness(F.col("_fp"), F.col("_efp")).alias("near_edited"), likeness(F.col("_fp"), F.col("_nfp")).alias("near_next"),
        F.when(picked, F.col("n_near")).alias("n_near"),
    )


@query("op10_simhash")
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return simhash_documents(documents(spark, folder))
