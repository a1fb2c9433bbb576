"""Runs of periodically repeated words in texts."""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, query
from shelfwise.llm.parts import chunks, starts, word_codes

#: Words of a run at least, and periods of a run at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Lags up to here are scanned over whole segments, longer ones from anchors.
DENSE_LAGS = 15
#: Words of the sequences that are compared at anchors; a run of a longer lag holds one from each of its first words on.
GRAM = 8
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def segments_of(codes, owner, least: int = LEAST_WORDS, times: int = LEAST_PERIODS):
    """Ends-exclusive stretches of words that may hold a run, after splitting at rare words until nothing changes.

    A word of a run occurs ``times`` times in it at least, one for each period. A word that occurs less often within its
    segment is in no run of that segment and splits it; the parts are segments of their own, in which other words
    may now be too rare. Segments shorter than ``least`` go. ``owner`` (ascending) tells texts apart; all texts of the batch
    are split together, each round by one count of (segment, word).
    """
    import numpy as np

    at, segment = np.arange(len(codes)), np.asarray(owner)
    while len(at):
        # A new segment where the owner changes or a word was left out.
        cut = np.concatenate([[True], (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1)])
        number = np.cumsum(cut) - 1
        long = np.bincount(number) >= least
        key = number * np.int64(codes.max() + 1) + codes[at]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        stay = long[number] & (count[which] >= times)
        if stay.all():
            first = np.flatnonzero(cut)
            return at[first], at[np.append(first[1:], len(at)) - 1] + 1
        at, segment = at[stay], number[stay]
    return np.zeros(0, "int64"), np.zeros(0, "int64")


def _stretches(same):
    """Starts and ends of the stretches of true values."""
    import numpy as np

    edge = np.diff(np.concatenate([[0], same.astype("int8"), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _extent(words, i: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``i`` in which words ``lag`` apart are identical: start, and end of the later words."""
    import numpy as np

    step, right = 256, i
    while right + lag < len(words):
        differ = np.flatnonzero(words[right : right + step][: len(words) - lag - right] != words[right + lag : right + lag + step])
        if len(differ):
            right += int(differ[0])
            break
        right = min(right + step, len(words) - lag)
        step *= 2
    step, left = 256, i
    while left > 0:
        low = max(0, left - step)
        differ = np.flatnonzero(words[low:left] != words[low + lag : left + lag])
        if len(differ):
            left = low + int(differ[-1]) + 1
            break
        left = low
        step *= 2
    return left, right + lag


def scan(words, least: int = LEAST_WORDS, times: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment, by start and period.

    Lags come in ascending order, so a stretch found again by a multiple of its period is known by its ends. Short lags
    are compared over the whole segment. For lags from ``b`` to 2``b`` - 1, a run is 3``b`` words long at least and holds
    an anchor, a multiple of ``b``, in its first ``b`` words, from which all words of a period are repeated one lag on: only lags at which
    the sequence of ``GRAM`` words at an anchor occurs again, and those at the middle and the end of the lag too, are extended. Lags that
    are multiples of a run around the anchor are passed over. Work is of the order of words times the logarithm of their number.
    """
    import numpy as np

    n, found = len(words), {}

    def keep(start: int, end: int, lag: int) -> None:
        if end - start >= max(least, times * lag):
            found.setdefault((start, end), lag)

    for lag in range(1, min(DENSE_LAGS, n // times) + 1):
        for start, end in zip(*_stretches(words[:-lag] == words[lag:]), strict=True):
            keep(int(start), int(end) + lag, lag)
    if n // times > DENSE_LAGS:
        gram = _grams(words)
        b = DENSE_LAGS + 1
        while b <= n // times:
            known = sorted((s, e, q) for (s, e), q in found.items())
            for i in range(0, n - GRAM + 1, b):
                window = gram[i + b : min(i + 2 * b, n // times + i + 1)]
                lags = b + np.flatnonzero(window == gram[i])
                # Of the first period, the sequences at the middle and at the end are repeated as well.
                lags = lags[i + 2 * lags - GRAM < len(gram)]
                lags = lags[(gram[i + lags // 2] == gram[i + lags // 2 + lags]) & (gram[i + lags - GRAM] == gram[i + 2 * lags - GRAM])]
                around = [r for r in known if r[0] <= i < r[1]] if len(lags) else []
                while len(lags):
                    for _, e, q in around:
                        lags = lags[(lags % q != 0) | (i + lags + GRAM > e)]
                    if not len(lags):
                        break
                    lag, lags = int(lags[0]), lags[1:]
                    start, end = _extent(words, i, lag)
                    size = len(found)
                    keep(start, end, lag)
                    if len(found) > size:
                        known.append((start, end, lag))
                        around.append((start, end, lag))
            b *= 2
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _grams(words):
    """A number for each sequence of ``GRAM`` words, equal for equal ones, by pairing neighbours of doubling width."""
    import numpy as np

    code, width = np.asarray(words, "int64"), 1
    while width < GRAM:
        code = np.unique(code[:-width] * np.int64(code.max() + 1) + code[width:], return_inverse=True)[1]
        width *= 2
    return code


def runs_of_batch(codes, offsets) -> list[list[tuple[int, int, int]]]:
    """Runs of each text of a batch; ``codes[offsets[i]:offsets[i + 1]]`` are text i's words."""
    import numpy as np

    out = [[] for _ in range(len(offsets) - 1)]
    owner = np.repeat(np.arange(len(out)), np.diff(offsets))
    for low, high in zip(*segments_of(codes, owner), strict=True):
        text = int(owner[low])
        shift = int(low - offsets[text])
        out[text] += [(shift + s, length, q) for s, length, q in scan(codes[low:high])]
    return out


def dropped(runs: list[tuple[int, int, int]], n: int):
    """Which of ``n`` words lie in a run after its first period."""
    import numpy as np

    cover = np.zeros(n + 1, "int64")
    for s, length, q in runs:
        cover[s + q] += 1
        cover[s + length] -= 1
    return np.cumsum(cover[:n]) > 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", transform=None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: all runs of each whole text, and its words without repeated periods.

    A run is a maximal stretch of words with smallest period q, at least 24 words and 3q long. Batches are split at words that
    occur too rarely within their segment to join a run, recursively until nothing changes (``segments_of``); what
    survives is scanned lag by lag (``scan``). ``runs`` has ``start`` (word number from 0), ``length``, ``period``, by start and period; of
    a run, the words after its first period are left out of ``collapsed``, whose words are joined by one space. ``transform(ids,
    codes, offsets)`` may change the words of a batch first (the query plants runs with it).

    A text is looked at by one task, in time of the order of its length times a logarithm; nothing is shuffled.

    Defined cases: null and empty texts have no words, no runs and an empty ``collapsed``; very long texts are a batch of their own; repeated
    rows and null ids give a row each; no rows give none; other columns are left out and cannot clash.
    """
    import pyarrow as pa

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import numpy as np

        for batch in batches:
            for i, n in chunks(batch.column(1)):
                codes, distinct, at = word_codes(batch.column(1).slice(i, n))
                ids = batch.column(0).slice(i, n)
                if transform is not None:
                    codes = transform(ids.to_pylist(), codes, at)
                found = runs_of_batch(codes, at)
                gone = np.zeros(len(codes), bool)
                for k, runs in enumerate(found):
                    if runs:
                        gone[at[k] : at[k + 1]] = dropped(runs, int(at[k + 1] - at[k]))
                words = np.array(distinct.to_pylist(), object)[codes[~gone]] if len(codes) else np.zeros(0, object)
                left = starts(~gone)[at]
                text = [" ".join(words[a:b]) for a, b in zip(left[:-1], left[1:], strict=True)]
                flat = np.array([r for runs in found for r in runs], "int64").reshape(-1, 3)
                ends = pa.array(starts([len(r) for r in found]).astype("int32"))
                structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=["start", "length", "period"])
                arrays = [ids, pa.array(np.diff(at)), pa.ListArray.from_arrays(ends, structs), pa.array(text, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")


def plant(ids, codes, offsets):
    """Words of the documents whose id's checksum ends in 0, repeated periodically from a word on, as the query asks."""
    import numpy as np

    out = codes.copy()
    for k, doc in enumerate(ids):
        n = int(offsets[k + 1] - offsets[k])
        h = zlib.crc32(str(doc).encode())
        if doc is None or h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at = int(offsets[k]) + a
        out[at : at + n - a] = codes[at + np.arange(n - a) % p]
    return out


def digests(runs: DataFrame) -> DataFrame:
    """The run with the greatest exponent (ties: smallest start, then period) and digests of all runs and of the kept words."""
    # Exponents are compared exactly, as products of whole numbers.
    best = F.aggregate(
        "runs", F.try_element_at("runs", F.lit(1)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    out = runs.withColumn("_best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"), F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of all documents, a tenth of them with a planted run."""
    return digests(periodic_runs(documents(spark, folder), transform=plant))
