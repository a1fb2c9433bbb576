"""Best-fit packing of token pieces by linear grouping."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, query, ranked, stage
from shelfwise.llm.parts import chunks, ranges
from shelfwise.llm.tokens import ended, vocabulary


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: documents' ids with the end id, longer ones cut.

    A document longer than ``capacity`` is cut into pieces of ``capacity``; the first takes what is over.

    Defined cases: null and empty texts are one piece with the end id alone; very long texts are encoded whole, a batch of
    their own; repeated rows give their pieces each; null ids pass through; no rows give none; other columns are left out.
    """
    import numpy as np
    import pyarrow as pa

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for i, n in chunks(batch.column(1)):
                ids, at = ended(batch.column(1).slice(i, n), tokenizer)
                ids, sizes = ids.astype("<u4"), np.diff(at)
                number = -(-sizes // capacity)
                row, piece = np.repeat(np.arange(n), number), ranges(np.zeros(n, "int64"), number)
                end = (sizes[row] - 1) % capacity + 1 + piece * capacity
                start = np.where(piece == 0, 0, end - capacity)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((at[row] + start).tolist(), (at[row] + end).tolist(), strict=True)]
                arrays = [batch.column(0).slice(i, n).take(pa.array(row)), pa.array(piece.astype("int32")), pa.array(start), pa.array(end - start), pa.array(crc, "int64")]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def group_sizes(counts: dict[int, int], groups: int) -> dict[int, int]:
    """Length to rounded length: lengths fall in groups of about equal cardinality and round up to the longest of theirs."""
    total, seen, by_group = sum(counts.values()), 0, {}
    for length in sorted(counts):
        by_group.setdefault(min(groups - 1, seen * groups // max(total, 1)), []).append(length)
        seen += counts[length]
    return {n: max(lengths) for lengths in by_group.values() for n in lengths}


def _best_pattern(sizes: list[int], prices, capacity: int) -> tuple[float, tuple[int, ...]]:
    """The multiset of sizes within ``capacity`` with the highest total price (an unbounded knapsack by number of items)."""
    import numpy as np

    most = capacity // min(sizes)
    worth, taken = [np.zeros(capacity + 1)], []
    for _ in range(most):
        best, which = np.full(capacity + 1, -1.0), np.full(capacity + 1, -1, "int64")
        for j, s in enumerate(sizes):
            with_j = np.where(worth[-1][: capacity + 1 - s] >= 0, worth[-1][: capacity + 1 - s] + prices[j], -1.0)
            better = with_j > best[s:] + 1e-12
            best[s:][better] = with_j[better]
            which[s:][better] = j
        worth.append(best)
        taken.append(which)
    k = int(np.argmax([w.max() for w in worth]))
    at, items = int(worth[k].argmax()), []
    value = float(worth[k][at])
    for level in range(k, 0, -1):
        j = int(taken[level - 1][at])
        items.append(j)
        at -= sizes[j]
    return value, tuple(sorted(items))


def configurations(demand: dict[int, int], capacity: int, steps: int = 20_000) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of few sizes with whole multiplicities that use up most of ``demand`` (size to count).

    The linear program over all patterns is solved by column generation: the dual prices of the present
    basis price a knapsack, whose best pattern enters the basis. The solution is rounded down; what that leaves, less
    than one pattern's worth per size, is returned by nobody and packed by best fit.
    """
    import numpy as np

    sizes = sorted(demand)
    if not sizes:
        return []
    need = np.array([float(demand[s]) for s in sizes])
    g = len(sizes)
    patterns = [tuple([j] * (capacity // s)) for j, s in enumerate(sizes)]
    column = lambda p: np.bincount(np.array(p, "int64"), minlength=g).astype(float)
    basis = np.column_stack([column(p) for p in patterns])
    amount = np.linalg.solve(basis, need)
    for _ in range(steps):
        prices = np.linalg.solve(basis.T, np.ones(g))
        value, pattern = _best_pattern(sizes, np.maximum(prices, 0.0), capacity)
        if value <= 1 + 1e-9:
            break
        change = np.linalg.solve(basis, column(pattern))
        ratio = np.where(change > 1e-9, amount / np.where(change > 1e-9, change, 1.0), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column(pattern)
        patterns[out] = pattern
        amount = np.maximum(np.linalg.solve(basis, need), 0.0)
    left, plan = Counter(demand), []
    for pattern, x in sorted(zip(patterns, amount, strict=True), key=lambda y: -y[1]):
        uses = Counter(sizes[j] for j in pattern)
        copies = min([int(x + 1e-6), *(left[s] // n for s, n in uses.items())])
        if copies > 0:
            plan.append((tuple(sizes[j] for j in pattern), copies))
            left.subtract({s: n * copies for s, n in uses.items()})
    return plan


def best_fit(room: dict[int, int], items: dict[int, int], capacity: int) -> list[tuple[int, int, tuple[int, ...]]]:
    """Best fit, longest first, on counts: (room at first, sequences, lengths added to each of them).

    ``room``: free tokens to number of sequences; ``items``: length to number of pieces. Sequences of equal
    room and history are one class, split when only some of them get a piece; new sequences are
    opened when no class has room. Work grows with the number of distinct lengths, not of pieces.
    """
    classes: dict[int, list[list]] = {}
    for free, n in room.items():
        classes.setdefault(free, []).append([free, n, ()])
    frees = sorted(classes)

    def add(free: int, entry: list) -> None:
        if free not in classes:
            classes[free] = []
            frees.insert(bisect_left(frees, free), free)
        classes[free].append(entry)

    for length in sorted(items, reverse=True):
        left = items[length]
        while left:
            at = bisect_left(frees, length)
            if at == len(frees):
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    add(capacity - each * length, [capacity, full, (length,) * each])
                if rest:
                    add(capacity - rest * length, [capacity, 1, (length,) * rest])
                break
            free = frees[at]
            entry = classes[free].pop()
            if not classes[free]:
                del classes[free]
                frees.pop(at)
            first, n, added = entry
            each = free // length
            full = min(n, left // each)
            if full:
                add(free - each * length, [first, full, added + (length,) * each])
                left -= full * each
            if n - full:
                if left and left < each:
                    add(free - left * length, [first, 1, added + (length,) * left])
                    left = 0
                    full += 1
                if n - full:
                    add(free, [first, n - full, added])
    return [(first, n, added) for entries in classes.values() for first, n, added in entries]


def kept_rooms(rooms: Counter, pieces: Counter, over: dict[int, int], capacity: int) -> tuple[int, dict[int, int], dict[int, int]]:
    """Which sequences stay as they were configured: (highest level of room, rooms of those that stay, lengths for best fit).

    ``rooms``: (level, room) to sequences; ``pieces``: (level, length) to their pieces; ``over``: length to other pieces. Sequences whose pieces
    leave more room than short pieces can fill are taken apart again. Each level is tried on counts by best fit and the one with the fewest
    sequences wins, the highest of several; none may stay, so there are never more than by best fit on all pieces.
    """
    best = None
    for most in sorted({-1, *(level for level, _ in rooms)}, reverse=True):
        room, left = Counter(), Counter(over)
        for (level, free), n in rooms.items():
            if level <= most:
                room[free] += n
        for (level, length), n in pieces.items():
            if level > most:
                left[length] += n
        used = sum(n for _, n, _ in best_fit(dict(room), dict(left), capacity))
        if best is None or used < best[0]:
            best = used, most, dict(room), dict(left)
    return best[1:]


def _intervals(spark: SparkSession, plan: list[tuple[int | None, int, tuple[int, ...]]]) -> tuple[DataFrame, DataFrame]:
    """Rank intervals of a plan [(room, sequences, lengths)]: where pieces go, and which sequences they go to.

    Pieces: by length, ranks from ``low`` to ``high``, ``each`` to a sequence, which is number ``base`` + rank // each.
    Sequences: by room, ranks from ``low`` to ``high``, numbers from ``base``.
    """
    pieces, rooms, seen, opened, base = [], [], Counter(), Counter(), 0
    for room, n, lengths in plan:
        for length, each in sorted(Counter(lengths).items()):
            pieces.append((length, seen[length], seen[length] + n * each, each, base))
            seen[length] += n * each
        rooms.append((room, opened[room], opened[room] + n, base))
        opened[room] += n
        base += n
    return (
        spark.createDataFrame(pieces, "_size bigint, _low bigint, _high bigint, _each bigint, _base bigint"),
        spark.createDataFrame(rooms, "_room bigint, _low bigint, _high bigint, _base bigint"),
    )


def _placed(rows: DataFrame, cells: DataFrame, on: str) -> DataFrame:
    """Rows with the interval of their rank; the intervals of one length are few and bounded by ``capacity``."""
    inside = (rows[on] == cells[on]) & (rows["_rank"] >= cells["_low"]) & (rows["_rank"] < cells["_high"])
    return rows.join(F.broadcast(cells), inside).drop(cells[on])


def pack(pieces: DataFrame, capacity: int = 2048, small: int = 256, groups: int = 48) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Linear grouping: pieces longer than ``small`` fall into ``groups`` groups of about equal cardinality
    and round up to the longest of their group; a linear program finds the best
    configurations of the few sizes, whose multiplicities are rounded down. Actual pieces take the
    places of their group. Sequences whose actual pieces leave more room than short ones can fill are taken apart
    (``kept_rooms``). What is over and the small pieces are then put by best fit, longest first, into the
    room that the actual lengths leave, and into new sequences.

    The driver plans on counts by length (``capacity`` numbers at most, whatever the input); rows are
    placed by their rank within a length or group, found without a window over it, against rank
    intervals whose number is bounded by ``capacity``: these are the only tables broadcast.

    Defined cases: equal rows are separate pieces; no pieces give no rows; nulls in other columns do
    not matter; columns starting with ``_`` and the two new names must be free.
    """
    spark = pieces.sparkSession
    order = [F.col("length"), *[F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns]]
    pieces = stage(pieces, "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rounded = group_sizes({n: c for n, c in counts.items() if n > small}, groups)
    demand = Counter()
    for n, size in rounded.items():
        demand[size] += counts[n]
    plan = configurations(demand, capacity)
    sizes = spark.createDataFrame([*rounded.items(), *[(n, 0) for n in counts if n <= small]], "length bigint, _size bigint")
    rows = ranked(pieces.join(F.broadcast(sizes), "length"), order, ["_size"], purpose="pack-large")
    cells, _ = _intervals(spark, [(None, n, lengths) for lengths, n in plan])
    inside = (rows["_size"] == cells["_size"]) & (rows["_rank"] >= cells["_low"]) & (rows["_rank"] < cells["_high"])
    rows = rows.join(F.broadcast(cells), inside, "left").drop(cells["_size"])
    number = F.col("_base") + F.floor((F.col("_rank") - F.col("_low")) / F.col("_each"))
    rows = stage(rows.select(*pieces.columns, number.cast("long").alias("_sequence")), "pack-first")

    large, rest = rows.where("_sequence is not null"), rows.where("_sequence is null").drop("_sequence")
    # The room that a sequence's actual pieces leave, and its order of magnitude: 0, 1, 2 to 3, 4 to 7, ...
    opened = large.groupBy("_sequence").agg((F.lit(capacity) - F.sum("length")).cast("long").alias("_room"), F.collect_list("length").alias("_lengths"))
    opened = stage(opened.withColumn("_level", F.length(F.when(F.col("_room") > 0, F.bin("_room")).otherwise(F.lit("")))), "pack-rooms")
    rooms_of = Counter({(r["_level"], r["_room"]): r["n"] for r in opened.groupBy("_level", "_room").agg(F.count("*").alias("n")).collect()})
    pieces_of = opened.select("_level", F.explode("_lengths").alias("length")).groupBy("_level", "length").agg(F.count("*").alias("n"))
    pieces_of = Counter({(r["_level"], r["length"]): r["n"] for r in pieces_of.collect()})
    over = {r["length"]: r["n"] for r in rest.groupBy("length").agg(F.count("*").alias("n")).collect()}
    most, room, left = kept_rooms(rooms_of, pieces_of, over, capacity)
    large = large.join(opened.select("_sequence", "_level"), "_sequence")
    rest = rest.unionByName(large.where(F.col("_level") > most).drop("_sequence", "_level"))
    large, opened = large.where(F.col("_level") <= most).drop("_level"), opened.where(F.col("_level") <= most).select("_sequence", "_room")
    cells, rooms = _intervals(spark, best_fit(room, left, capacity))
    rest = ranked(rest.withColumn("_size", F.col("length")), order, ["_size"], purpose="pack-rest")
    rest = _placed(rest, cells, "_size").withColumn("_sequence", F.col("_base") + F.floor((F.col("_rank") - F.col("_low")) / F.col("_each")))
    opened = _placed(ranked(opened, [F.col("_sequence")], ["_room"], purpose="pack-opened"), rooms, "_room")
    opened = opened.select("_sequence", (F.col("_base") + F.col("_rank") - F.col("_low")).alias("sequence_id"))
    large = large.join(opened, "_sequence")
    both = large.select(*pieces.columns, "sequence_id").unionByName(rest.select(*pieces.columns, F.col("_sequence").cast("long").alias("sequence_id")))
    inner = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("offset", F.coalesce(F.sum("length").over(inner), F.lit(0)).cast("long"))


@query("op7_pack_documents")
def op7_pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' pieces and their places in sequences of 2048 tokens."""
    return pack(token_pieces(documents(spark, folder), vocabulary("byte_bpe_50k.json")))
