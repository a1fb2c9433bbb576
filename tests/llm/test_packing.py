import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np

from shelfwise.llm.packing import best_fit, configurations, group_sizes, op7_pack_documents, pack, token_pieces
from shelfwise.llm.tokens import Encoder, vocabulary
from tests.test_queries import FOLDER

PATH = vocabulary("byte_bpe_50k.json")


def sound(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def fitted(counts, capacity):
    """Sequences by plain best fit, longest first, one piece at a time."""
    rooms, used = [], 0
    for length in sorted(counts.elements(), reverse=True):
        at = bisect_left(rooms, length)
        if at == len(rooms):
            used += 1
            insort(rooms, capacity - length)
        else:
            insort(rooms, rooms.pop(at) - length)
    return used


def test_never_more_than_best_fit(spark):
    r = random.Random(8)
    for shape in (lambda: r.randint(1, 512), lambda: int(r.betavariate(2, 3) * 511) + 1, lambda: r.choice((170, 171, 172, 256, 257)), lambda: r.randint(150, 200)):
        lengths = [shape() for _ in range(1500)]
        table = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
        rows = pack(table, 512, 64, 12).collect()
        assert sorted(x["length"] for x in rows) == sorted(lengths)
        assert sound(rows, 512) <= fitted(Counter(lengths), 512)


def test_all_documents(spark):
    rows = op7_pack_documents(spark, FOLDER).collect()
    tool, pieces = Encoder(PATH), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert set(pieces) == {d["doc_id"] for d in docs}
    total = 0
    for d in docs:
        ids = np.append(np.frombuffer(tool.encode([d["text"]])[0], "<u4"), np.array([0], "<u4")).astype("<u4")
        mine = sorted(pieces[d["doc_id"]], key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(mine):
            assert (r["piece"], r["start"]) == (k, at) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 2048 for r in mine[1:]) and len(mine) == -(-len(ids) // 2048)
        total += at
    used = sound(rows, 2048)
    assert used >= -(-total // 2048) and used <= fitted(Counter(r["length"] for r in rows), 2048)


def test_configurations_cover_their_demand():
    r = random.Random(3)
    for _ in range(20):
        demand = {s: r.randint(1, 3000) for s in r.sample(range(260, 2049), 12)}
        plan = configurations(demand, 2048)
        used = Counter()
        for sizes, n in plan:
            assert sum(sizes) <= 2048 and n > 0
            for s in sizes:
                used[s] += n
        assert all(used[s] <= demand[s] for s in used)
        bound = sum(s * n for s, n in demand.items()) / 2048
        assert sum(n for _, n in plan) >= bound - 12 - sum((demand[s] - used[s]) for s in demand)
        # Rounding down leaves less than a pattern for each size.
        assert sum(s * (demand[s] - used[s]) for s in demand) <= 13 * 2048
    assert configurations({}, 2048) == []


def test_known_optimum():
    # Halves, thirds and sixths of the capacity fit exactly.
    plan = configurations({1024: 600, 682: 600, 341: 600}, 2048)
    assert sum(n for _, n in plan) <= 601


def test_best_fit_places_everything():
    r = random.Random(4)
    for _ in range(50):
        room = {r.randint(0, 900): r.randint(1, 40) for _ in range(10)}
        items = {r.randint(1, 700): r.randint(1, 90) for _ in range(12)}
        plan = best_fit(room, items, 2048)
        placed, rooms = Counter(), Counter()
        for free, n, lengths in plan:
            assert sum(lengths) <= free and n > 0
            rooms[free] += n
            for x in lengths:
                placed[x] += n
        assert placed == Counter(items) and all(rooms[f] == n for f, n in room.items())


def test_groups_have_about_equal_cardinality():
    sizes = group_sizes({n: 3 for n in range(1, 101)}, 10)
    assert len(set(sizes.values())) == 10 and all(sizes[n] >= n for n in sizes)


def test_odd_rows(spark, odd_docs, no_docs, all_null):
    rows = pack(token_pieces(odd_docs, PATH, 512), 512, 64, 8).collect()
    sound(rows, 512)
    assert len({(r["doc_id"], r["piece"]) for r in rows if r["doc_id"] == 8}) == 1 and sum(r["doc_id"] == 8 for r in rows) == 3
    assert pack(token_pieces(no_docs, PATH)).collect() == []
    assert sorted((r["length"], r["offset"]) for r in pack(token_pieces(all_null, PATH)).collect()) == [(1, 0), (1, 1), (1, 2)]
