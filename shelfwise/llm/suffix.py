"""Removal of repeated passages by sorted suffixes."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, query, ranked, row_key, stage, text_table
from shelfwise.llm.wordhash import mix

#: Bytes of a repeated string, and bytes of the sampled suffixes' leading tokens.
LENGTH, GRAM = 100, 32
#: Suffixes that a task sorts at a time, about; some half a kilobyte each.
RANGE_ROWS = 200_000
#: Window starts handled at once; longer texts are cut into overlapping stretches.
STRETCH = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def byte_column(column):
    """(bytes of all values, offsets) of an Arrow binary column."""
    import numpy as np

    data = column.buffers()[2]
    offsets = np.frombuffer(column.buffers()[1], "int32")[column.offset : column.offset + len(column) + 1].astype("int64")
    return (np.frombuffer(data, "uint8") if data is not None else np.zeros(0, "uint8")), offsets


def gram_hashes(data, gram: int = GRAM):
    """64-bit hash of each stretch of ``gram`` bytes (a power of two), by doubling."""
    import numpy as np

    if len(data) < gram:
        return np.zeros(0, "uint64")
    hashes, span, factor = data.astype("uint64") + np.uint64(0x51ED27), 1, _MULTIPLIER
    while span < gram:
        hashes = hashes[:-span] * np.uint64(factor) + hashes[span:]
        span, factor = span * 2, factor * factor & (1 << 64) - 1
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(29))


def sampled_suffixes(data, ends, length: int = LENGTH, gram: int = GRAM):
    """(hash, suffix start, first and last window start) of the suffixes sampled from texts that lie one after another.

    Each window of ``length`` bytes picks the suffix that starts in it with the smallest hash of its first
    ``gram`` bytes, the leftmost of equals. Which one depends on the window's bytes only, so
    equal windows pick equal places. Windows that pick the same suffix follow each other.
    """
    import numpy as np

    hashes, wide = gram_hashes(data, gram), length - gram + 1
    none = (np.zeros(0, "uint64"), *[np.zeros(0, "int64")] * 3)
    if len(hashes) < wide:
        return none
    place = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(len(hashes), dtype="uint64")
    least, span = place, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: len(place) - wide + 1], least[wide - span :])
    valid = np.ones(len(least), bool)
    for end in ends:
        valid[max(0, end - length + 1) : end] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return none
    pick = (least[at] & np.uint64((1 << 24) - 1)).astype("int64")
    new = np.concatenate(([True], (pick[1:] != pick[:-1]) | (at[1:] != at[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:] - 1, [len(at) - 1]))
    return hashes[pick[first]], pick[first], at[first], at[last]


def _stretches(offsets):
    """(first text, texts, start, end) of stretches to scan: several short texts, or a part of a long one."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = i + 1
        while j < n and offsets[j + 1] - offsets[i] <= STRETCH:
            j += 1
        if offsets[j] - offsets[i] <= 2 * STRETCH:
            yield i, j, int(offsets[i]), int(offsets[j])
        else:
            for a in range(int(offsets[i]), int(offsets[i + 1]), STRETCH):
                yield i, i + 1, a, min(a + STRETCH + LENGTH - 1, int(offsets[i + 1]))
            j = i + 1
        i = j


def _sample(batches):
    """Rows (hash, key, packed place, sure) of the sampled suffixes: first window start, distance to the suffix and to the last window start.

    A hash that occurs again within a batch is shared for sure: one of its rows keeps the hash, so that others
    find it, the rest get hashes of their own. So a line that is everywhere costs a few rows per batch at its hash.
    """
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        data, offsets = byte_column(batch.column(1))
        keys = batch.column(0).to_numpy()
        found = [[np.zeros(0, "uint64")], [np.zeros(0, "int64")], [np.zeros(0, "int64")]]
        for i, j, a, b in _stretches(offsets):
            hashes, start, low, high = sampled_suffixes(data[a:b], offsets[i + 1 : j + 1].clip(max=b) - a)
            text = np.searchsorted(offsets[i : j + 1] - a, low, "right") - 1 + i
            found[0].append(hashes)
            found[1].append(keys[text])
            found[2].append(((low + a - offsets[text]) << 14) | ((start - low) << 7) | (high - low))
        hashes, owner, packed = (np.concatenate(f) for f in found)
        _, first, inverse, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        sure = count[inverse] > 1
        again = sure.copy()
        again[first] = False
        own = mix(packed[again].astype("uint64") ^ mix(owner[again].astype("uint64")))
        hashes[again] = own
        arrays = [pa.array(hashes.view("int64")), pa.array(owner), pa.array(packed), pa.array(sure)]
        yield pa.RecordBatch.from_arrays(arrays, names=["_h", "_key", "_place", "_sure"])


def _contexts(batches):
    """Bytes around each shared suffix: to the right as far as its windows reach, to the left reversed."""
    import pyarrow as pa

    for batch in batches:
        right, left, texts, low = [], [], [], []
        for uid, raw, places in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            for packed in places:
                lo, to, span = packed >> 14, packed >> 7 & 127, packed & 127
                x = lo + to
                right.append(raw[x : lo + span + LENGTH])
                left.append(raw[lo:x][::-1])
                texts.append(uid)
                low.append(lo)
        arrays = [pa.array(right, "binary"), pa.array(left, "binary"), pa.array(texts, "int64"), pa.array(low, "int64")]
        yield pa.RecordBatch.from_arrays(arrays, names=["_right", "_left", "_uid", "_low"])


def padded(values: list[bytes], width: int):
    """Rows of ``width`` bytes, padded with zeros, and their lengths."""
    import numpy as np

    sizes = np.fromiter(map(len, values), "int64", len(values))
    out = np.zeros((len(values), width), "uint8")
    out[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(values), "uint8")
    return out, sizes


def multikey_order(rows, sizes):
    """Order of byte rows: multikey quicksort with eight bytes as one character, equal rows by length.

    Each step sorts only the rows that are equal so far by their next character.
    """
    import numpy as np

    words = np.column_stack([rows.view(">u8").astype("uint64"), sizes.astype("uint64")])
    order, group, open_ = np.arange(len(rows)), np.zeros(len(rows), "int64"), np.arange(len(rows))
    for k in range(words.shape[1]):
        if not len(open_):
            break
        some, mine = order[open_], group[open_]
        step = np.lexsort((words[some, k], mine))
        order[open_] = some = some[step]
        character = words[some, k]
        new = np.concatenate(([True], (mine[1:] != mine[:-1]) | (character[1:] != character[:-1])))
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(open_)))
        group[open_] = np.repeat(open_[first], count)
        open_ = open_[np.repeat(count, count) > 1]
    return order


def common_prefixes(rows, sizes, order):
    """Length of the common prefix of each row and the one before it in order; the first has -1."""
    import numpy as np

    out = np.full(len(order), -1, "int64")
    if len(order) > 1:
        a, b = rows[order[:-1]], rows[order[1:]]
        differ = a != b
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[1:] = np.minimum(lcp, np.minimum(sizes[order[:-1]], sizes[order[1:]]))
    return out


def _bucket(batches):
    """Repeated windows of one range of suffixes, and the windows to compare across its boundaries.

    Suffixes are sorted to the right of the sampled place, and what precedes them to the left; two windows at
    the same distance from the place are equal when both sorts hold them in one run of long enough
    common prefixes. Rows: (uid, start, end, null) for bytes of repeated windows, (uid, start, end, window) for the first
    windows of runs that reach the range's first or last suffix.
    """
    import numpy as np
    import pyarrow as pa

    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    uid, low = table.column("_uid").to_numpy(), table.column("_low").to_numpy()
    right, right_size = padded(table.column("_right").to_pylist(), 104)
    left, left_size = padded(table.column("_left").to_pylist(), 72)
    del table
    place = low + left_size
    # In order of text and place; a repeated row of the input is one suffix.
    order = np.lexsort((low, place, uid))
    same = np.zeros(len(order), bool)
    same[1:] = (np.diff(uid[order]) == 0) & (np.diff(place[order]) == 0) & (np.diff(low[order]) == 0)
    order = order[~same]
    uid, place, right, right_size, left, left_size = (v[order] for v in (uid, place, right, right_size, left, left_size))
    n = len(uid)
    by_right, by_left = multikey_order(right, right_size), multikey_order(left, left_size)
    lcp_right, lcp_left = common_prefixes(right, right_size, by_right), common_prefixes(left, left_size, by_left)
    repeated = np.zeros((n, LENGTH - GRAM + 1), bool)
    run_right, run_left = np.empty(n, "int64"), np.empty(n, "int64")
    edges = []
    for back in range(LENGTH - GRAM + 1):
        need = LENGTH - back
        run_right[by_right] = np.cumsum(lcp_right < need)
        run_left[by_left] = np.cumsum(lcp_left < back)
        here = np.flatnonzero((left_size >= back) & (right_size >= need))
        if not len(here):
            continue
        _, first = np.unique(run_right[here] * (n + 1) + run_left[here], return_index=True)
        later = np.ones(len(here), bool)
        later[first] = False
        repeated[here[later], back] = True
        heads = here[first]
        touching = heads[(run_right[heads] == run_right[by_right[0]]) | (run_right[heads] == run_right[by_right[-1]])]
        for i in touching:
            edges.append((int(uid[i]), int(place[i]) - back, left[i, :back][::-1].tobytes() + right[i, :need].tobytes()))
    # Along a suffix, repeated windows at neighbouring distances make one stretch of bytes.
    edge = np.zeros((n, 1), bool)
    change = np.diff(np.concatenate([edge, repeated, edge], axis=1).astype("int8"), axis=1)
    row, near = np.nonzero(change == 1)
    far = np.nonzero(change == -1)[1] - 1
    ids = np.concatenate((uid[row], np.array([e[0] for e in edges], "int64")))
    starts = np.concatenate((place[row] - far, np.array([e[1] for e in edges], "int64")))
    ends = np.concatenate((place[row] - near + LENGTH, np.array([e[1] + LENGTH for e in edges], "int64")))
    windows = pa.array([None] * len(row) + [e[2] for e in edges], "binary")
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(starts), pa.array(ends), windows], names=["_uid", "_start", "_end", "_window"])


def merged(spans) -> list[tuple[int, int]]:
    """Union of stretches, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _cut(as_text: bool):
    """What is left of texts without their repeated bytes, as bytes or as text."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for raw, starts, ends in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
                spans = merged(zip(starts, ends, strict=True))
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                kept = b"".join([*kept, raw[at:]])
                left = kept.decode("utf-8", "ignore") if as_text else kept
                out.append((len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), left))
            columns = list(zip(*out, strict=True)) or [()] * 4
            arrays = [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, ("int64", "int64", "string", "string" if as_text else "binary"), strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["_key", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def ranges_for(rows: int) -> int:
    """Ranges of ``RANGE_ROWS`` rows each, about, that so many suffixes take."""
    return max(1, -(-rows // RANGE_ROWS))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """``docs`` (as struct ``_row``, its text as ``_text``) with ``n_bytes, n_removed, n_spans, kept_sha256, kept``.

    Every byte goes that a string of 100 bytes covers which also starts earlier, in a text with a smaller id
    or before in the same text; strings are judged on the input and lie within a text. ``kept`` (binary) is what is
    left where some bytes go, else null; with ``as_text`` it is a string, without characters whose bytes were cut apart.

    Method. Equal texts are settled by their digest: the first stays for now, later ones of 100 bytes or more go whole.
    In the others each window of 100 bytes picks one suffix (see ``sampled_suffixes``), about one in 35, of which
    only those whose first 32 bytes hash alike somewhere go on. Their bytes, up to the ends of
    the windows, are range-partitioned at sampled splitters, in order of the bytes to the right, then to the
    left, then of the place, so that no run of equal suffixes has to stay together. A range is sorted by multikey quicksort; runs of common
    prefixes give the repeated windows, compared as bytes. First windows of runs that reach a range's boundary are compared
    across ranges, one row per window and range. Each text is staged once by row key and never shuffled.

    Defined cases: null text is empty; null ids come last; rows that repeat id and text are the same document and get
    equal results; equal ids with other texts are ordered by the text's digest; no rows give no rows;
    other columns are carried in ``_row``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_row"), F.col(id_col).alias("_id"), text.alias("_text"))
    rows = rows.withColumns({"_key": row_key(F.col("_id"), F.col("_text")), "_digest": F.sha2("_text", 256), "n_bytes": F.octet_length("_text").cast("long")})
    rows = text_table(rows, "_key", "suffix")
    order = F.struct(F.col("_id").isNull().alias("_last"), F.col("_id"), F.col("_key"))
    narrow = rows.groupBy("_key", "_id", "_digest", "n_bytes").agg(F.count("*").alias("_n"))
    first = narrow.groupBy("_digest", "n_bytes").agg(F.min(order).alias("_o")).select("_digest", "n_bytes", "_o._last", "_o._id", "_o._key")
    first = stage(ranked(first, [F.col("_last"), F.col("_id"), F.col("_digest")], name="_uid", purpose="suffix-order").select("_uid", "_key", "n_bytes"), "suffix-first")
    long_enough = first.where(F.col("n_bytes") >= LENGTH).select("_key", "_uid")

    raw = rows.select("_key", F.col("_text").cast("binary").alias("_raw"))
    found = raw.join(long_enough, "_key").select("_uid", "_raw").mapInArrow(_sample, "_h bigint, _key bigint, _place bigint, _sure boolean")
    alike = Window.partitionBy("_h")
    shared = found.withColumn("_n", F.count("*").over(alike)).where("_n > 1 or _sure").groupBy(F.col("_key").alias("_uid")).agg(F.collect_set("_place").alias("_places"))
    shared = shared.join(long_enough, "_uid")
    around = raw.join(shared, "_key").select("_uid", "_raw", "_places").mapInArrow(_contexts, "_right binary, _left binary, _uid bigint, _low bigint")
    around = stage(around, "suffix-contexts")
    # A range is sorted in memory: with the rows, their number grows beyond the session's setting.
    ranges, by = ranges_for(around.count()), ["_right", "_left", "_uid", "_low"]
    ranged = around.repartitionByRange(ranges, *by) if ranges > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else around.repartitionByRange(*by)
    spans = stage(ranged.mapInArrow(_bucket, "_uid bigint, _start bigint, _end bigint, _window binary"), "suffix-spans")
    across = Window.partitionBy("_window").orderBy("_uid", "_start")
    edges = spans.where("_window is not null").withColumn("_nth", F.row_number().over(across)).where("_nth > 1")
    spans = spans.where("_window is null").select("_uid", "_start", "_end").union(edges.select("_uid", "_start", "_end"))
    spans = spans.groupBy("_uid").agg(F.collect_list(F.struct("_start", "_end")).alias("_s")).join(long_enough, "_uid")
    cut = raw.join(spans, "_key").select("_key", "_raw", F.col("_s._start").alias("_a"), F.col("_s._end").alias("_b"))
    cut = cut.mapInArrow(_cut(as_text), f"_key bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept {'string' if as_text else 'binary'}")
    cut = stage(cut, "suffix-cut").dropDuplicates(["_key"])

    state = first.select("_key", F.lit(True).alias("_first"))
    out = rows.join(state, "_key", "left").join(cut, "_key", "left")
    gone = F.col("_first").isNull() & (F.col("n_bytes") >= LENGTH)
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "_row", "_text", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "_digest")).alias("kept_sha256"),
        F.when(gone, F.lit("" if as_text else b"")).otherwise(F.col("kept")).alias("kept"),
    )


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with what their repeated passages take away."""
    cut = suffix_dedup(documents(spark, folder).select("doc_id", "text"))
    return cut.select("_row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
