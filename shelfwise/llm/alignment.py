"""Alignment of two vocabularies' tokens over the same texts."""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, query, stage
from shelfwise.llm.parts import Pieces, chunks, ranges, split, starts
from shelfwise.llm.tokens import encoder, vocabulary
from shelfwise.operators.skew import join_one

#: Bits of a pair's number that hold the second vocabulary's id.
B_BITS = 32
#: Bytes of text that become one row of blocks; a smaller batch needs less memory, a larger one shares more parts.
BLOCK_BYTES = 4 << 20
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@lru_cache(maxsize=1)
def tools(pairs: str, pieces: str) -> tuple:
    """Both encoders, the first one's token bytes, and the decimal names of ids with what may follow them."""
    import numpy as np

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a, b = encoder(pairs), Pieces(pieces)
    back = {letter: value for value, letter in a.letters.items()}
    a_bytes = np.array([bytes(back[c] for c in name) if all(c in back for c in name) else name.encode() for name in a.names], object)
    names = lambda n, ends: [np.array([f"{i}{e}" for i in range(n)], object) for e in ends]
    return a, b, a_bytes, names(len(a.names), ",|"), names(len(b.bytes), ",;")


def overlaps(a, b):
    """Pairs of tokens of the same document whose byte ranges overlap: rows (doc, a, b) of places in the two frames.

    ``a`` and ``b`` have ``doc, start``, ordered by ``start``, which runs through all documents of the batch; the tokens of either side
    cover a document without gaps. Each token's start finds the covering token of the other side; of two overlapping tokens
    the later start lies in the other token, so the two directions together give every pair, equal starts once.
    """
    import pandas as pd

    a, b = a.assign(a=range(len(a))), b.assign(b=range(len(b)))
    there = pd.merge_asof(a, b.assign(at=b["start"]), on="start", by="doc")
    here = pd.merge_asof(b, a.assign(at=a["start"]), on="start", by="doc")
    here = here[here["at"] != here["start"]]
    return pd.concat([there[["doc", "a", "b"]], here[["doc", "a", "b"]]], ignore_index=True)


def align_parts(words, pairs: str, pieces: str) -> dict:
    """Figures of parts that follow a space each: tokens, groups, links, text of the groups, pairs of ids; ``bad`` where bytes differ."""
    import numpy as np
    import pandas as pd

    a, b, a_bytes, (a_comma, a_bar), (b_comma, b_end) = tools(pairs, pieces)
    n = len(words)
    (a_ids, a_at), (b_ids, b_at) = a.spaced(words), b.spaced(words)
    raw = [b" " + w.encode() for w in words.to_pylist()]
    a_tokens, b_tokens = a_bytes[a_ids], b.bytes[b_ids]
    bad = np.zeros(n, bool)
    whole = b"".join(raw)
    for tokens, at in ((a_tokens, a_at), (b_tokens, b_at)):
        if b"".join(tokens) != whole:
            bad |= np.array([b"".join(tokens[i:j]) != r for i, j, r in zip(at[:-1], at[1:], raw, strict=True)], bool)
    if bad.any():
        # Parts whose bytes differ have no tokens.
        out = []
        for ids, tokens, at in ((a_ids, a_tokens, a_at), (b_ids, b_tokens, b_at)):
            sizes = np.diff(at)
            good = np.repeat(~bad, sizes)
            out += [ids[good], tokens[good], starts(np.where(bad, 0, sizes))]
        a_ids, a_tokens, a_at, b_ids, b_tokens, b_at = out
    part = [np.repeat(np.arange(n), np.diff(at)) for at in (a_at, b_at)]
    # Both sides cover the same bytes, so places in the batch's bytes are places of either.
    a_end, b_end_at = (np.cumsum([len(t) for t in tokens], dtype="int64") if len(tokens) else np.zeros(0, "int64") for tokens in (a_tokens, b_tokens))
    size = lambda ends: np.diff(np.concatenate([[0], ends]))
    frame = lambda p, ends: pd.DataFrame({"doc": p, "start": ends - size(ends)})
    links = overlaps(frame(part[0], a_end), frame(part[1], b_end_at))
    code = (a_ids[links["a"].to_numpy()].astype("int64") << B_BITS) | b_ids[links["b"].to_numpy()].astype("int64")
    of = links["doc"].to_numpy()
    order = np.argsort(of, kind="stable")

    a_cut, b_cut = np.isin(a_end, b_end_at, assume_unique=True), np.isin(b_end_at, a_end, assume_unique=True)
    # A group's first tokens come first, then its second ones: a token comes after all of earlier groups on the other side.
    a_group, b_group = (np.concatenate([[0], np.cumsum(cut)[:-1]]).astype("int64") if len(cut) else np.zeros(0, "int64") for cut in (a_cut, b_cut))
    a_of, b_of = starts(np.bincount(a_group)), starts(np.bincount(b_group))
    text = np.empty(len(a_ids) + len(b_ids), object)
    text[np.arange(len(a_ids)) + b_of[a_group]] = np.where(a_cut, a_bar[a_ids], a_comma[a_ids])
    text[np.arange(len(b_ids)) + a_of[b_group + 1]] = np.where(b_cut, b_end[b_ids], b_comma[b_ids])
    both = (a_at + b_at).tolist()
    return {
        "bad": bad, "n_a": np.diff(a_at), "n_b": np.diff(b_at), "n_groups": np.bincount(part[0][a_cut], minlength=n),
        "n_links": np.bincount(of, minlength=n), "pair_at": starts(np.bincount(of, minlength=n)), "pairs": code[order],
        "text": np.array(["".join(text[i:j]) for i, j in zip(both[:-1], both[1:], strict=True)], object),
    }


def _packed(numbers) -> bytes:
    import numpy as np
    import pyarrow as pa

    return np.int64(len(numbers)).tobytes() + pa.compress(numbers.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes):
    import numpy as np
    import pyarrow as pa

    n = int(np.frombuffer(data[:8], "<i8")[0])
    return np.frombuffer(pa.decompress(data[8:], decompressed_size=4 * n, codec="zstd", asbytes=True), "<u4").astype("int64")


def block_rows(pairs: str, pieces: str, kind):
    """A row for each batch of texts: what is known of its documents, their parts, the parts' pairs of ids, and the batch's count of each pair."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        nth = 0
        for batch in batches:
            for i, n in chunks(batch.column(1), BLOCK_BYTES):
                parts = split(batch.column(1).slice(i, n))
                by = align_parts(parts.distinct, pairs, pieces)
                sizes = np.diff(parts.offsets)
                of = np.repeat(np.arange(n), sizes)
                out = np.bincount(of, weights=by["bad"][parts.codes], minlength=n) > 0
                good = ~out[of]
                codes, sizes = parts.codes[good], np.where(out, 0, sizes)
                at = starts(sizes)
                total = lambda name: np.diff(starts(by[name][codes])[at])
                text = by["text"]
                sha = ["" if a == b else hashlib.sha256("".join(text[codes[a:b]])[:-1].encode()).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                # Parts by how often they occur, so that the numbers compress.
                often = np.bincount(codes, minlength=len(parts.distinct))
                order = np.argsort(-often, kind="stable")
                order = order[often[order] > 0]
                place = np.zeros(len(often), "int64")
                place[order] = np.arange(len(order))
                each = np.diff(by["pair_at"])[order]
                found = by["pairs"][ranges(by["pair_at"][order], each)]
                known, which = np.unique(found, return_inverse=True)
                count = np.bincount(which, weights=np.repeat(often[order], each), minlength=len(known)).astype("int64")
                one = lambda x, t: pa.array([x], t)
                row = {
                    "block": pa.array([(TaskContext.get().partitionId() << 32) + nth], "int64"),
                    "ids": pa.ListArray.from_arrays(pa.array([0, n], "int32"), batch.column(0).slice(i, n)),
                    **{k: one(total(k), pa.list_(pa.int64())) for k in ("n_a", "n_b", "n_groups", "n_links")},
                    "sha": one(sha, pa.list_(pa.string())), "sizes": one(_packed(sizes), pa.binary()), "codes": one(_packed(place[codes]), pa.binary()),
                    "part_pairs": one(_packed(each), pa.binary()), "which": one(_packed(which), pa.binary()),
                    "pairs": one(known, pa.list_(pa.int64())), "counts": one(count, pa.list_(pa.int64())),
                }
                nth += 1
                yield pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

    figures = ", ".join(f"{k} array<bigint>" for k in ("n_a", "n_b", "n_groups", "n_links"))
    schema = f"block bigint, ids array<{kind}>, {figures}, sha array<string>, sizes binary, codes binary, part_pairs binary, which binary, pairs array<bigint>, counts array<bigint>"
    return run, schema


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, a_id, b_id, count, best``: how many links hold each pair of ids, and whether no other pair of its second id has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("_p")).select(F.col("_p.pairs").alias("pair"), F.col("_p.counts").alias("_n"))
    counts = each.groupBy("pair").agg(F.sum("_n").alias("count")).withColumn("b_id", F.col("pair").bitwiseAND((1 << B_BITS) - 1))
    counts = stage(counts, "align-counts")
    most = counts.groupBy("b_id").agg(F.max("count").alias("_most"))
    out = join_one(counts, most, ["b_id"])
    return out.select("pair", F.shiftright("pair", B_BITS).alias("a_id"), "b_id", "count", (F.col("count") == F.col("_most")).alias("best"))


def align(docs: DataFrame, pairs: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Tokens of each whole text by two vocabularies, aligned by bytes: (rows per document, counts of id pairs).

    Documents: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. Texts are cut before spaces at which both
    vocabularies begin a token, so a document's alignment is that of its parts end to end, and no group or link leaves a
    part. Each distinct part of a batch is encoded and aligned once by ``overlaps`` (``pandas.merge_asof`` in both directions, keyed by
    part); equal ends cut the groups. A batch (4 MiB of text or one longer text) becomes one row with its documents, parts and the
    count of each of its id pairs. Counts are summed over batches by pair; a batch then gets the totals of the
    pairs it holds, never those of a document, so what is shuffled follows the distinct pairs of batches, not the links.

    Defined cases: null and empty texts, and texts whose tokens' bytes are not those of the text after a space (a literal
    U+2581), have zeros and an empty digest, and count in no total; repeated rows count as often as they occur; ids may be null or
    repeat; very long texts are a batch of their own; no rows give none; other columns are left out and cannot clash.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    run, schema = block_rows(pairs, pieces, kind)
    blocks = stage(rows.mapInArrow(run, schema), "align-blocks")
    counts = stage(pair_counts(blocks), "align-pairs")
    places = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    known = join_one(places, counts.select("pair", "count", "best"), ["pair"]).select(F.col("block").alias("_block"), "at", "count", "best")

    def figures(own, totals):
        import numpy as np
        import pandas as pd

        # One row a batch.
        r = own.iloc[0]
        count, best = np.zeros(len(totals), "int64"), np.zeros(len(totals), "int64")
        count[totals["at"]], best[totals["at"]] = totals["count"], totals["best"]
        each, which, codes, sizes = (_unpacked(r[k]) for k in ("part_pairs", "which", "codes", "sizes"))
        at, of = starts(sizes), starts(each)
        total = lambda value: np.diff(starts(np.diff(starts(value[which])[of])[codes])[at])
        out = {"doc_id": r["ids"], **{k: r[k] for k in ("n_a", "n_b", "n_groups", "n_links")}, "n_best": total(best), "count_sum": total(count), "groups_sha256": r["sha"]}
        return pd.DataFrame(out)

    own = blocks.drop("pairs", "counts")
    result = own.groupBy("block").cogroup(known.groupBy("_block")).applyInPandas(figures, f"doc_id {kind}, {', '.join(f'{k} bigint' for k in FIGURES)}, groups_sha256 string")
    return result, counts


@query("op13_align_tokens")
def op13_align_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Alignment of all documents' tokens by the byte-pair and the sentence-piece vocabulary."""
    return align(documents(spark, folder), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))[0]
