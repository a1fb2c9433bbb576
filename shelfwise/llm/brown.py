"""Class-based bigram language model with classes from exchange clustering."""

from __future__ import annotations

import functools
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, query, stage

#: Words whose pairs are counted by word and moved in rounds (the most frequent); all others move by their pairs with classes.
CLUSTERED = 4096
#: Classes, all open to every word.
EXCHANGE = 80
#: Of these, the last ones, in which all words but the clustered begin, by their last two bytes.
ENDINGS = 32
#: Most frequent words whose counts and classes every task holds; those of all others are joined.
HEAD = 131_072
ROUNDS, BLOCKS = 6, 12
ADD = 0.1
#: Weight of a class's own frequency in transitions, for each class seen after the one before.
BACK_OFF = 16
#: Ids: clustered words, then the first classes of other words, then the end of a text.
END_ID, IDS = CLUSTERED + ENDINGS, CLUSTERED + ENDINGS + 1
FIRST, END_CLASS, CLASSES = EXCHANGE - ENDINGS, EXCHANGE, EXCHANGE + 1
#: A word's pairs: with each class after it, with each class before it, with itself.
PAIRS = 2 * CLASSES + 1
#: Place in a coded text of a word whose class is joined.
OPEN = 255
#: What a text's row holds in ``_coded``.
TEXT = ["_seq", "_tokens", "_known", "_base", "_id", "_held"]
#: Bytes of text taken at a time; words, and words to be moved, that a task holds before it gives their sums; rows that it gives at a time.
STRETCH, HELD, MOVING, SLICE = 1 << 21, 2_000_000, 600_000, 100_000


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


@functools.cache
def _endings():
    """``ending`` by a word's last two bytes, after these by the byte of a word of one."""
    import numpy as np

    return np.array([ending(bytes((a, b))) for a in range(256) for b in range(256)] + [ending(bytes((a,))) for a in range(256)], "int64")


def endings(words):
    """``ending`` of each word."""
    import numpy as np

    if not len(words):
        return np.zeros(0, "int64")
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, "int32")[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, "uint8")
    last = data[at[1:] - 1].astype("int64")
    return _endings()[np.where(np.diff(at) == 1, 65_536 + last, data[at[1:] - 2] * np.int64(256) + last)]


def _split(texts):
    """Lower-case words (A to Z only are lowered) of texts, one after another, and how many each text has."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words, at = lists.flatten(), lists.offsets.to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    before = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
    return words.filter(full), np.diff(before[at])


def pieces(texts):
    """(words, sizes, ended): words of texts in order, a few megabytes at a time, and how many each text has; the last text of a piece
    that has not ended goes on in the next. Null texts are empty, long ones are cut at blanks."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = texts.fill_null(b"") if texts.null_count else texts
    to = np.cumsum(pc.binary_length(texts).to_numpy().astype("int64"))
    a = 0
    while a < len(to):
        start = to[a - 1] if a else 0
        b = int(np.searchsorted(to, start + STRETCH, side="right"))
        if b > a:
            yield *_split(texts.slice(a, b - a)), True
            a = b
            continue
        raw, at = texts[a].as_py(), 0
        while at < len(raw):
            end = at + STRETCH
            while end < len(raw) and raw[end] not in b"\t\n\x0b\x0c\r ":
                end += 1
            yield *_split(pa.array([raw[at:end]], "binary")), end >= len(raw)
            at = end
        a += 1


def _word_array(words: list[bytes]):
    import pyarrow as pa

    return pa.array(words, "binary").view(pa.string())


def _places(words, known):
    """Place of each word in ``known``, -1 for others."""
    import pyarrow.compute as pc

    return pc.index_in(words, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)


def _slices(rows):
    """A batch in parts, so that the other side of the pipe need not hold it in one piece."""
    for at in range(0, rows.num_rows, SLICE):
        yield rows.slice(at, SLICE)


def _release() -> None:
    """Give back memory that the task no longer uses: the worker stays for other tasks."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()


def _line(last, values, sizes, ended, end):
    """``last``, then the values of texts' words, with ``end`` after each text that has ended."""
    import numpy as np

    line = np.full(len(values) + len(sizes) + 1, end, values.dtype)
    line[0] = last
    line[np.arange(1, len(values) + 1) + np.repeat(np.arange(len(sizes)), sizes)] = values
    return line if ended else line[:-1]


def _counts(batches):
    """(word, n): words of training texts, summed within the task."""
    import pyarrow as pa

    parts, held = [], 0

    def rows():
        words, n = pa.chunked_array(parts, pa.string()).value_counts().flatten()
        return pa.RecordBatch.from_arrays([words.view(pa.binary()), n], names=["_word", "_n"])

    for batch in batches:
        for words, _, _ in pieces(batch.column(0)):
            parts.append(words)
            held += len(words)
            if held > HELD:
                yield from _slices(rows())
                parts, held = [], 0
    if held:
        yield from _slices(rows())
    parts.clear()
    _release()


def _bigrams(known):
    """(pair, n): pairs of ids of neighbours in training texts, the text's end before its first word, summed within the task."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        parts, held = [], 0

        def rows():
            line = np.concatenate(parts)
            parts.clear()
            pairs, n = np.unique(line, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype("int64")), pa.array(n.astype("int64"))], names=["_pair", "_n"])

        for batch in batches:
            last = END_ID
            for words, sizes, ended in pieces(batch.column(0)):
                mine = _places(words, known).copy()
                far = np.flatnonzero(mine < 0)
                mine[far] = CLUSTERED + endings(words.take(pa.array(far)))
                line = _line(last, mine, sizes, ended, END_ID)
                parts.append(line[:-1] * np.int32(IDS) + line[1:])
                held += len(mine)
                last = line[-1]
                if held > 2 * HELD:
                    yield from _slices(rows())
                    held = 0
        if parts:
            yield from _slices(rows())
        _release()

    return run


def _log(x):
    import numpy as np

    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(after, before, self_pairs, current: int, table) -> int:
    """The class to which a word's move raises the likelihood of the class bigrams most; ``table`` is updated.

    ``after`` and ``before``: the word's pairs with each class to its right and left, pairs with itself
    (``self_pairs``) not included. The likelihood is the sum of n log n over class pairs less those over both margins; every
    candidate's change is found from the rows and columns that it touches.
    """
    import numpy as np

    table[current] -= after
    table[:, current] -= before
    table[current, current] -= self_pairs
    rows, columns = table.sum(axis=1), table.sum(axis=0)
    k = EXCHANGE
    gain = (_log(table[:k] + after) - _log(table[:k])).sum(axis=1) + (_log(table[:, :k] + before[:, None]) - _log(table[:, :k])).sum(axis=0)
    own, a, b = table[np.arange(k), np.arange(k)], after[:k], before[:k]
    # The class's own cell is touched by both sums and by the word's pairs with itself.
    gain += _log(own + a + b + self_pairs) - _log(own + a) - _log(own + b) + _log(own)
    out, in_ = after.sum() + self_pairs, before.sum() + self_pairs
    gain -= _log(rows[:k] + out) - _log(rows[:k]) + _log(columns[:k] + in_) - _log(columns[:k])
    best = int(gain.argmax())
    if gain[best] <= gain[current] + 1e-9:
        best = current
    table[best] += after
    table[:, best] += before
    table[best, best] += self_pairs
    return best


def _moves(table):
    """Words of a block, most frequent first, moved one after another on a copy of the class table."""

    def run(frame):
        import numpy as np
        import pandas as pd

        mine, out = table.copy(), []
        for word, rows in sorted(frame.groupby("_w"), key=lambda g: (-g[1]["_n"].sum(), g[0])):
            after, before = np.zeros(CLASSES), np.zeros(CLASSES)
            current, own = int(rows["_own"].iloc[0]), 0.0
            for side, other, n in zip(rows["_side"], rows["_c"], rows["_n"], strict=True):
                if side == 2:
                    own = float(n)
                else:
                    (after if side == 0 else before)[other] += n
            out.append((word, exchange(after, before, own, current, mine)))
        return pd.DataFrame(out, columns=["_w", "_c"])

    return run


def cluster(bigrams: DataFrame, rounds: int = ROUNDS) -> list[int]:
    """Class of each id by exchange clustering over the pair counts (_a, _b, _n); what is held here is bounded by ids and classes.

    In a round words' pairs are summed by the neighbour's class, words are dealt to blocks, and each block's words
    move one after another on the class table of the round's start. Every other word moves in a round, so that
    words do not follow each other in circles.
    """
    import numpy as np

    spark = bigrams.sparkSession
    classes = [i % FIRST for i in range(CLUSTERED)] + [FIRST + i for i in range(ENDINGS)] + [END_CLASS]
    for turn in range(rounds):
        known = F.broadcast(spark.createDataFrame(list(enumerate(classes)), "_i int, _k int"))
        coded = bigrams.join(known.toDF("_a", "_ca"), "_a").join(known.toDF("_b", "_cb"), "_b")
        table = _class_table(coded)
        same = F.col("_a") == F.col("_b")
        moving = lambda w: (F.col(w) < CLUSTERED) & (F.col(w) % 2 == turn % 2)
        right = coded.where(moving("_a") & ~same).select(F.col("_a").alias("_w"), F.col("_ca").alias("_own"), F.lit(0).alias("_side"), F.col("_cb").alias("_c"), "_n")
        left = coded.where(moving("_b") & ~same).select(F.col("_b").alias("_w"), F.col("_cb").alias("_own"), F.lit(1).alias("_side"), F.col("_ca").alias("_c"), "_n")
        twice = coded.where(moving("_a") & same).select(F.col("_a").alias("_w"), F.col("_ca").alias("_own"), F.lit(2).alias("_side"), F.col("_ca").alias("_c"), "_n")
        sums = right.union(left).union(twice).groupBy("_w", "_own", "_side", "_c").agg(F.sum("_n").alias("_n"))
        moved = sums.groupBy(F.floor(F.col("_w") / 2) % BLOCKS).applyInPandas(_moves(table), "_w int, _c int").collect()
        changed = [(r["_w"], r["_c"]) for r in moved if classes[r["_w"]] != r["_c"]]
        if not changed and turn:
            break
        for w, c in changed:
            classes[w] = c
    return [int(c) for c in np.array(classes)]


def _class_table(coded: DataFrame):
    """Counts of class pairs, at most the classes squared."""
    import numpy as np

    table = np.zeros((CLASSES, CLASSES))
    for r in coded.groupBy("_ca", "_cb").agg(F.sum("_n").alias("_n")).collect():
        table[r["_ca"], r["_cb"]] = r["_n"]
    return table


def _contexts(known, classes: list[int]):
    """(word, pairs): how often a word that is not clustered has which class after and before it, and itself, summed within the task.

    ``pairs`` holds n * PAIRS + kind of pair, four bytes each. Neighbours count by the class that they have before any of these words moves.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        pool, lines, size, held = [], [], 0, 0

        def rows():
            x, y, cx, cy = np.concatenate(lines, axis=1)
            lines.clear()
            coded = pa.concat_arrays(pool).view(pa.binary()).dictionary_encode()
            at = coded.indices.to_numpy()
            right, left = x >= 0, y >= 0
            same = right & left
            same[same] = at[x[same]] == at[y[same]]
            after, before = right & ~same, left & ~same
            # Words and pairs held are so few that these fit into four bytes.
            keys = np.concatenate([at[x[after]] * PAIRS + cy[after], at[y[before]] * PAIRS + CLASSES + cx[before], at[x[same]] * PAIRS + 2 * CLASSES])
            del x, y, cx, cy, right, left, same, after, before
            keys, n = np.unique(keys, return_counts=True)
            word = keys // PAIRS
            starts = np.flatnonzero(np.diff(word, prepend=np.int32(-1)))
            offsets = np.append(starts, len(keys)).astype("int32") * np.int32(4)
            pairs = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer((n * PAIRS + keys % PAIRS).astype("int32"))])
            return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(word[starts])), pairs], names=["_word", "_pairs"])

        start = np.array(classes, "int32")
        for batch in batches:
            last, place = END_CLASS, -1
            for words, sizes, ended in pieces(batch.column(0)):
                mine = _places(words, known)
                far = np.flatnonzero(mine < 0)
                rare = words.take(pa.array(far))
                kinds, places = start[mine], np.full(len(mine), -1, "int32")
                kinds[far] = FIRST + endings(rare)
                places[far] = size + np.arange(len(far))
                pool.append(rare)
                size += len(far)
                kinds, places = _line(last, kinds, sizes, ended, END_CLASS), _line(place, places, sizes, ended, -1)
                line = np.stack([places[:-1], places[1:], kinds[:-1], kinds[1:]])
                lines.append(line[:, (line[0] >= 0) | (line[1] >= 0)])
                held += len(mine)
                last, place = int(kinds[-1]), int(places[-1])
                if size > MOVING or held > 2 * HELD:
                    kept = [pa.concat_arrays(pool).take(pa.array([place]))] if place >= 0 else []
                    if any(line.shape[1] for line in lines):
                        yield from _slices(rows())
                    pool, lines, size, held, place = kept, [], len(kept), 0, len(kept) - 1
        if any(line.shape[1] for line in lines):
            yield from _slices(rows())
        pool.clear()
        _release()

    return run


def choose(word, kind, n, current, table):
    """Class of each word by the greatest gain in likelihood, each judged on the same class table, which has all words in it.

    ``word``, ``kind``, ``n``: pairs of the words, sorted by word number from 0, each kind once a word. The gains are found from the
    cells that a word's pairs touch, and are the full changes of the likelihood (see ``exchange``).
    """
    import numpy as np

    k, count = EXCHANGE, len(current)
    a, b, self_pairs = np.zeros((count, CLASSES)), np.zeros((count, CLASSES)), np.zeros(count)
    side = np.minimum(kind // CLASSES, 2)
    a[word[side == 0], kind[side == 0]] = n[side == 0]
    b[word[side == 1], kind[side == 1] - CLASSES] = n[side == 1]
    self_pairs[word[side == 2]] = n[side == 2]
    every, own = np.arange(count), np.arange(k)
    gain = np.zeros((count, k))

    # A pair's cell in each class, before the word is there: its own class has the word's pairs already.
    cells = np.concatenate([table[:k].T, table[:, :k]])
    linked = side < 2
    w, j, m = word[linked], kind[linked], n[linked].astype("float64")
    few = m <= 8
    steps = np.stack([_log(cells + x) - _log(cells) for x in range(9)])
    for some in (few, ~few):
        for at in range(0, int(some.sum()), 16_384):
            pick = np.flatnonzero(some)[at : at + 16_384]
            i, c, x = w[pick], j[pick], m[pick]
            up = steps[x.astype("int64"), c] if some is few else _log(cells[c] + x[:, None]) - _log(cells[c])
            mine = cells[c, current[i]]
            up[np.arange(len(pick)), current[i]] = _log(mine) - _log(mine - x)
            first = np.flatnonzero(np.diff(i, prepend=-1))
            gain[i[first]] += np.add.reduceat(up, first)

    # Cells touched twice: the class's own, by the pairs on both sides and with the word itself ...
    inner = np.tile(table[own, own], (count, 1))
    inner[every, current] -= a[every, current] + b[every, current] + self_pairs
    p, q, s = a[:, :k], b[:, :k], np.broadcast_to(self_pairs[:, None], (count, k))
    i, c = np.nonzero(((p > 0) & (q > 0)) | (s > 0))
    t, p, q, s = inner[i, c], p[i, c], q[i, c], s[i, c]
    gain[i, c] += _log(t + p + q + s) - _log(t)
    # ... which the sums above have taken as two cells, in the word's class without the other side.
    here = c == current[i]
    full = t + p + q + s
    right = np.where(here, _log(full) - _log(full - p), _log(t + p) - _log(t))
    left = np.where(here, _log(full) - _log(full - q), _log(t + q) - _log(t))
    gain[i, c] -= right + left
    # ... and those between a class and the word's, which lose the word's pairs from the other side first.
    for one, other, cell in ((a, b, lambda i, c: table[c, current[i]]), (b, a, lambda i, c: table[current[i], c])):
        i, c = np.nonzero((one[every, current] > 0)[:, None] & (other[:, :k] > 0))
        away = c != current[i]
        i, c = i[away], c[away]
        t, x, less = cell(i, c), one[i, current[i]], other[i, c]
        gain[i, c] += _log(t - less + x) - _log(t - less) - _log(t + x) + _log(t)

    for margin, sums in ((table.sum(axis=1), a), (table.sum(axis=0), b)):
        moved, free = sums.sum(axis=1) + self_pairs, margin[:k]
        amounts, at = np.unique(moved, return_inverse=True)
        change = (_log(free + amounts[:, None]) - _log(free))[at]
        change[every, current] = _log(free[current]) - _log(free[current] - moved)
        gain -= change
    best = gain.argmax(axis=1)
    return np.where(gain[every, best] > gain[every, current] + 1e-9, best, current)


def _whole(batches, starts):
    """Batches put together so that a group, which begins where ``starts`` says, is in one piece; rows are in order."""
    import pyarrow as pa

    kept = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = starts(batch, kept[-1] if kept else None)
        if len(cuts):
            done = [b for b in [*kept, batch.slice(0, cuts[-1])] if b.num_rows]
            if done:
                yield pa.Table.from_batches(done).combine_chunks()
            kept = [batch.slice(cuts[-1])]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _words_begin(batch, before):
    """Rows whose word is another than the row's before."""
    import numpy as np
    import pyarrow.compute as pc

    column = batch.column(0)
    other = np.flatnonzero(pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)) + 1
    first = before is None or column[0].as_py() != before.column(0)[before.num_rows - 1].as_py()
    return np.concatenate(([0], other)) if first else other


def _content(column, kind: str):
    """Places where the values of a binary column begin and the last ends, in numbers of a kind, and these numbers."""
    import numpy as np

    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, "int32")[column.offset : column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(data, "uint8")[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, "uint8")
    return (at - at[0]).astype("int64") // size, raw.view(kind)


def _assign(table):
    """(word, n, class) from words' pairs in the order of the words."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for rows in _whole(batches, _words_begin):
            column = rows.column(0).combine_chunks()
            coded = column.dictionary_encode()
            offsets, pairs = _content(rows.column(1).combine_chunks(), "int32")
            of = np.repeat(coded.indices.to_numpy(), np.diff(offsets)).astype("int64")
            keys, at = np.unique(of * PAIRS + pairs % PAIRS, return_inverse=True)
            n = np.bincount(at, pairs // PAIRS).astype("int64")
            word, kind = keys // PAIRS, keys % PAIRS
            names = coded.dictionary
            current = FIRST + endings(names)
            ahead = (kind < CLASSES) | (kind == 2 * CLASSES)
            total = np.bincount(word[ahead], n[ahead], minlength=len(names)).astype("int64")
            found = current.copy()
            for a in range(0, len(names), 2000):
                b = min(a + 2000, len(names))
                some = slice(*np.searchsorted(word, (a, b)))
                found[a:b] = choose(word[some] - a, kind[some], n[some], current[a:b], table)
            yield pa.RecordBatch.from_arrays([names, pa.array(total), pa.array(found.astype("int32"))], names=["_word", "_n", "_c"])

    return run


def _coded(model):
    """A row per text with its words' classes, a byte each, and its sums over head words; a row per other word of it.

    Text rows have a word that no text has (it begins with a blank), different for each, so that they do not meet anywhere.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        head, group, unit, seen = model.value
        names = ["_at", "_pos", "_word", "_text"]

        def rows(at, pos, words, text):
            return pa.RecordBatch.from_arrays([pa.array(at, "int64"), pa.array(pos, "int64"), words, text], names=names)

        def text_rows(at, seq, sizes, near, base, *more):
            sums = [seq, pa.array(sizes + 1), pa.array(near + seen), pa.array(base + unit[-1]), *more]
            return rows(at, np.full(len(at), -1), pa.array([b" %d" % key for key in at.tolist()], "binary"), pa.StructArray.from_arrays(sums, TEXT))

        for batch in batches:
            keys, first = batch.column(0).to_numpy(), 0
            # Of a text that goes on: its number of words, known words, base and classes.
            size, known, base, seqs = 0, 0, 0.0, []
            for words, sizes, ended in pieces(batch.column(1)):
                ids = _places(words, head)
                starts, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
                far = np.flatnonzero(ids < 0)
                if len(far):
                    blank = pa.nulls(len(far), pa.struct([("_seq", pa.binary()), ("_tokens", pa.int64()), ("_known", pa.int64()), ("_base", pa.float64()), ("_id", batch.column(2).type), ("_held", pa.bool_())]))
                    yield rows(keys[first + of[far]], size + far - starts[of[far]], words.take(pa.array(far)).view(pa.binary()), blank)
                near = np.bincount(of[ids >= 0], minlength=len(sizes))
                sums = np.bincount(of, np.where(ids < 0, 0.0, unit[ids]), len(sizes))
                codes = group[ids]
                if seqs or not ended:
                    size, known, base = size + len(ids), known + int(near[0]), base + float(sums[0])
                    seqs.append(codes.tobytes())
                    if not ended:
                        continue
                    sizes, near, sums = np.array([size]), np.array([known]), np.array([base])
                    starts, codes = np.zeros(1, "int64"), np.frombuffer(b"".join(seqs), "uint8")
                    size, known, base, seqs = 0, 0, 0.0, []
                offsets = np.append(starts, len(codes)).astype("int32")
                seq = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(codes)])
                yield text_rows(keys[first : first + len(sizes)], seq, sizes, near, sums, *(batch.column(i).slice(first, len(sizes)) for i in (2, 3)))
                first += len(sizes)
        _release()

    return run


def _complete(batches):
    """Rows per text with the classes and counts of all its words, from a text's row and those of its joined words, in order."""
    import numpy as np
    import pyarrow as pa

    def begin(batch, _):
        return np.flatnonzero(batch.column(0).to_numpy() < 0)

    for rows in _whole(batches, begin):
        pos, kind, n = (rows.column(i).to_numpy() for i in range(3))
        starts = np.flatnonzero(pos < 0)
        rare = np.flatnonzero(pos >= 0)
        of = np.searchsorted(starts, rare) - 1
        text = dict(zip(TEXT, rows.column(3).combine_chunks().take(pa.array(starts)).flatten(), strict=True))
        offsets, codes = _content(text["_seq"], "uint8")
        codes = codes.copy()
        codes[offsets[of] + pos[rare]] = kind[rare]
        seq = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype("int32")), pa.py_buffer(codes)])
        known = text["_known"].to_numpy() + np.bincount(of[n[rare] > 0], minlength=len(starts))
        base = text["_base"].to_numpy() + np.bincount(of, np.log10(n[rare] + ADD), len(starts))
        yield pa.RecordBatch.from_arrays([text["_id"], text["_held"], text["_tokens"], pa.array(known), pa.array(base), seq], names=["_id", "_held", "_tokens", "_known", "_base", "_seq"])


def _steps(column):
    """(cells, starts): cells of the class table that texts' words pass, each text's from its end before its first word to its end; places where texts begin."""
    import numpy as np

    offsets, codes = _content(column, "uint8")
    line = _line(END_CLASS, codes, np.diff(offsets), True, END_CLASS).astype("int32")
    return line[:-1] * CLASSES + line[1:], offsets[:-1] + np.arange(len(column))


def _transitions(batches):
    """(cell, n): neighbouring classes, summed within the task."""
    import numpy as np
    import pyarrow as pa

    table = np.zeros(CLASSES * CLASSES, "int64")
    for batch in batches:
        if batch.num_rows:
            table += np.bincount(_steps(batch.column(0))[0], minlength=len(table))
    cells = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(table[cells])], names=["_pair", "_n"])


def smoothed(table):
    """p(class | class before), mixed with the classes' own frequencies (Witten and Bell) with a weight of ``BACK_OFF`` for each class seen after.

    Rare words' classes are chosen by the few pairs that are counted here, so that the counts alone look surer than they are.
    """
    alone = (table.sum(axis=0) + ADD) / (table.sum() + ADD * CLASSES)
    weight = BACK_OFF * (table > 0).sum(axis=1, keepdims=True) + 1.0
    return (table + weight * alone) / (table.sum(axis=1, keepdims=True) + weight)


def _scores(step, rest):
    """(id, split, counts, base, score) of coded texts."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        cells = (step - rest[None, :]).ravel()
        for batch in batches:
            if not batch.num_rows:
                continue
            # The end is the only word of its class: its own sum is taken off like any other's.
            steps, starts = _steps(batch.column(5))
            scores = np.add.reduceat(cells[steps], starts)
            base = batch.column(4).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(base + scores)], names=["_id", "_held", "_tokens", "_known", "_base", "_score"])

    return run


def most_frequent(counts: DataFrame, most: int, *more: str) -> list[tuple]:
    """Words by falling count, ``most`` at most: all whose count is above the one at which there would be more; with their values of ``more``.

    The bound comes from the numbers of words per count, so that no more than ``most`` rows reach the
    driver, however many tasks hold the counts.
    """
    run = Window.orderBy(F.desc("_n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = counts.groupBy("_n").agg(F.count("*").alias("_words")).withColumn("_run", F.sum("_words").over(run))
    least = sizes.where(F.col("_run") <= most).agg(F.min("_n")).first()[0]
    rows = [] if least is None else counts.where(F.col("_n") >= least).collect()
    return sorted(((bytes(r["_word"]), r["_n"], *(r[c] for c in more)) for r in rows), key=lambda r: (-r[1], r[0]))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: log10 probabilities of whole texts.

    Texts whose crc32 of the id (as text; null: empty) leaves 0 modulo 10 are held out; the model learns from
    the others. Tokens are lower-case words and an end. The model is p(class | class before) * p(word | class):
    every word of the training texts gets one of ``EXCHANGE`` classes by exchange clustering over all its pairs, the end its own.
    The ``CLUSTERED`` most frequent words move in rounds, the others in classes by their endings meanwhile; then all
    others move, each to the class that raises the likelihood most. A word that no training text has is
    taken into the class with most of the words of its ending. Transitions back off to the classes' frequencies (see ``smoothed``),
    emissions are smoothed by 0.1; a class keeps the mass of one unseen word. ``base_score`` is the unigram model's.

    Counts and pairs of all words, summed in the tasks first, are gathered from the whole corpus; tasks hold
    the ``HEAD`` most frequent words at most (a bounded table), the counts and classes of all other words are joined to the
    texts' words and put in their places, so that every transition is one of learned classes.

    Defined cases: null and empty texts consist of the end; null ids are held out; repeated rows are separate
    texts; without training texts every count is 0; no rows give no rows; other columns are left out, and cannot clash.
    """
    import numpy as np

    spark = docs.sparkSession
    held = (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0).alias("_held")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_raw"), held)
    train = rows.where("not _held").select("_raw")
    counts = stage(train.mapInArrow(_counts, "_word binary, _n bigint").groupBy("_word").agg(F.sum("_n").alias("_n")), "brown-counts")
    ends = train.count()
    first = most_frequent(counts, HEAD)[:CLUSTERED]
    clustered = _word_array([w for w, _ in first])
    pairs = train.mapInArrow(_bigrams(clustered), "_pair bigint, _n bigint").groupBy("_pair").agg(F.sum("_n").alias("_n"))
    pairs = stage(pairs.select(F.floor(F.col("_pair") / IDS).cast("int").alias("_a"), (F.col("_pair") % IDS).cast("int").alias("_b"), "_n"), "brown-pairs")
    classes = cluster(pairs)

    known = F.broadcast(spark.createDataFrame(list(enumerate(classes)), "_i int, _k int"))
    table = _class_table(pairs.join(known.toDF("_a", "_ca"), "_a").join(known.toDF("_b", "_cb"), "_b"))
    moving = train.mapInArrow(_contexts(clustered, classes), "_word binary, _pairs binary")
    moving = moving.repartition("_word").sortWithinPartitions("_word").mapInArrow(_assign(table), "_word binary, _n bigint, _c int")
    others = stage(moving, "brown-classes")

    # Words and occurrences of each class, and the class that has most words of an ending.
    size, words = np.zeros(CLASSES), np.zeros(CLASSES)
    by_ending = np.zeros((ENDINGS, EXCHANGE), "int64")
    last_two = F.crc32(F.expr("substring(_word, -2, 2)")) % ENDINGS
    for r in others.groupBy(last_two.cast("int").alias("_e"), "_c").agg(F.sum("_n").alias("n"), F.count("*").alias("v")).collect():
        size[r["_c"]] += r["n"]
        words[r["_c"]] += r["v"]
        by_ending[r["_e"], r["_c"]] = r["v"]
    for (_, n), c in zip(first, classes, strict=False):
        size[c] += n
        words[c] += 1
    total, distinct = int(size.sum()) + ends, int(words.sum()) + (ends > 0)
    size[END_CLASS], words[END_CLASS] = ends, 1
    unseen = [int(c) for c in by_ending.argmax(axis=1)]

    spare = most_frequent(others, HEAD - len(first), "_c")
    head = [(w, n, classes[i]) for i, (w, n) in enumerate(first)] + spare
    group = np.array([*(c for _, _, c in head), OPEN], "uint8")
    unit = np.log10(np.array([*(n for _, n, _ in head), ends], "float64") + ADD)
    shared = spark.sparkContext.broadcast((_word_array([w for w, _, _ in head]), group, unit, int(ends > 0)))
    texts = rows.withColumn("_at", F.monotonically_increasing_id())
    # The id and the split travel with the text's own row.
    kind = rows.schema["_id"].dataType.simpleString()
    text = f"_text struct<_seq: binary, _tokens: bigint, _known: bigint, _base: double, _id: {kind}, _held: boolean>"
    coded = texts.select("_at", "_raw", "_id", "_held").mapInArrow(_coded(shared), f"_at bigint, _pos bigint, _word binary, {text}")
    joined = coded.join(others, "_word", "left")
    by_word = F.element_at(F.array(*map(F.lit, unseen)), (last_two + 1).cast("int"))
    joined = joined.select("_at", "_pos", F.coalesce("_c", by_word).alias("_c"), F.coalesce("_n", F.lit(0)).alias("_n"), "_text")
    joined = joined.repartition("_at").sortWithinPartitions("_at", "_pos").drop("_at")
    whole = stage(joined.mapInArrow(_complete, f"_id {kind}, _held boolean, _tokens bigint, _known bigint, _base double, _seq binary"), "brown-coded")

    table = np.zeros(CLASSES * CLASSES)
    for r in whole.where("not _held").select("_seq").mapInArrow(_transitions, "_pair bigint, _n bigint").groupBy("_pair").agg(F.sum("_n").alias("_n")).collect():
        table[r["_pair"]] = r["_n"]
    table = table.reshape(CLASSES, CLASSES)
    rest = np.log10(size + ADD * (words + 1))
    step = np.log10(smoothed(table))
    out = whole.mapInArrow(_scores(step, rest), f"_id {kind}, _held boolean, _tokens bigint, _known bigint, _base double, _score double")
    base = F.col("_base") - F.col("_tokens") * F.lit(float(np.log10(total + ADD * (distinct + 1))))
    return out.select(F.col("_id").alias("doc_id"), F.col("_held").alias("held_out"), F.col("_tokens").alias("n_tokens"), F.col("_known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), F.col("_score").alias("score"))


@query("op8_brown_scores")
def op8_brown_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents by the class model and by words alone."""
    return score_documents(documents(spark, folder))
