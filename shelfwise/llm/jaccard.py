"""Exact Jaccard self-join of documents' word shingles, by partitioning the universe of tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, query, ranked, row_key, stage, text_table
from shelfwise.llm.suffix import byte_column
from shelfwise.llm.wordhash import mix, shingle_sets
from shelfwise.operators.skew import join_one

#: Share of segments that are indexed with their one-deletion neighbourhood.
RESERVE = 0.05
#: Rows of a key that are compared in one task; more are dealt out to several.
BLOCK = 2048
INDEX, PROBE = 1, 2


def band_starts(largest: int, num: int, den: int) -> list[int]:
    """Starts of the size bands up to ``largest``: a set's partners lie in its band or a neighbouring one."""
    out = [1]
    while out[-1] <= largest:
        out.append(out[-1] * den // num + 1)
    return out


def segments_of(band_end: int, num: int, den: int) -> int:
    """Segments of a band: one more than the elements in which linked sets may differ, the smaller at most ``band_end`` large."""
    other = band_end * den // num
    return (den - num) * (band_end + other) // (den + num) + 1


def _sum_by(values, segment, m: int):
    import numpy as np

    out = np.zeros(m, "uint64")
    np.add.at(out, segment, values)
    return out


def keys_of(tokens, band: int, m: int, roles: int):
    """(key, role) rows of one set in one band.

    Tokens hash to ``m`` segments; sets that differ in fewer than m elements agree on a segment. The first
    few segments are the reserve: the index holds their one-deletion neighbourhoods too. When
    probing, a segment of one token or none is the least selective, so it is skipped as long as there is a reserve segment
    of two tokens or more, largest first, that is probed up to one deletion instead: skipping costs one
    element of the bound, the wider probe gives one back, so the sum over the segments stays m.
    """
    import numpy as np

    spread = mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    segment = ((spread >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype("int64")
    element = mix(tokens + np.uint64(0x14057B7EF767814F))
    content, count = _sum_by(element, segment, m), np.bincount(segment, minlength=m)
    q = int(np.ceil(m * RESERVE)) if m > 1 else 0
    salt = mix(np.arange(2 * m, dtype="uint64") + np.uint64(band << 32))
    exact = mix(content + salt[:m])
    rows, kinds = [], []
    reserve = np.flatnonzero(segment < q)
    minus = content[segment[reserve]] - element[reserve]
    if roles & PROBE:
        low = np.flatnonzero(count <= 1)
        wide = np.flatnonzero(count[:q] >= 2)
        wide = wide[np.argsort(-count[wide], kind="stable")][: len(low)]
        low = low[~np.isin(low, wide)]
        low = low[np.argsort(count[low], kind="stable")][: len(wide)]
        role = np.full(m, roles)
        role[low] &= ~PROBE
        rows.append(exact[role > 0])
        kinds.append(role[role > 0])
        mine = np.isin(segment[reserve], wide[: len(low)])
        rows += [mix(minus[mine] + salt[segment[reserve][mine]]), mix(content[wide[: len(low)]] + salt[m + wide[: len(low)]])]
        kinds += [np.full(int(mine.sum()), PROBE), np.full(len(low), PROBE)]
    if roles & INDEX:
        rows.append(mix(minus + salt[m + segment[reserve]]))
        kinds.append(np.full(len(reserve), INDEX))
    return np.concatenate(rows), np.concatenate(kinds)


def coarse_counts(tokens):
    """Numbers of a set's tokens by the top bits of a hash, one byte each: half as many classes as tokens or more, a power of two."""
    import numpy as np

    bits = max(4, (len(tokens) - 1).bit_length() - 1)
    return np.bincount((mix(tokens) >> np.uint64(64 - bits)).astype("int64"), minlength=1 << bits).clip(max=255).astype("uint8")


def folded(counts, classes: int):
    """Counts for fewer classes: neighbours are added up."""
    return counts if len(counts) == classes else counts.reshape(classes, -1).sum(axis=1)


def _measure(size: int):
    """Rows (key, shingles, two hashes of the set, coarse counts)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            data, offsets = byte_column(batch.column(1))
            out = []
            for tokens in shingle_sets(data, offsets, size):
                one, two = mix(tokens + np.uint64(1)).sum(dtype="uint64"), mix(tokens ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype="uint64")
                out.append((len(tokens), int(one.view("int64")), int(two.view("int64")), coarse_counts(tokens).tobytes()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            arrays = [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, ("int64", "int64", "int64", "binary"), strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["_key", "_n", "_one", "_two", "_coarse"])

    return run


def _index(size: int, num: int, den: int):
    """Rows (segment key, set, role) of each set in its own band and, probing, in the next smaller one."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        starts = [1]
        for batch in batches:
            data, offsets = byte_column(batch.column(1))
            uids = batch.column(0).to_numpy()
            keys, sets, roles = [], [], []
            for uid, tokens in zip(uids, shingle_sets(data, offsets, size), strict=True):
                if len(tokens) >= starts[-1]:
                    starts = band_starts(len(tokens), num, den)
                band = int(np.searchsorted(starts, len(tokens), "right")) - 1
                for b, kind in ((band, INDEX | PROBE), (band - 1, PROBE)):
                    if b >= 0:
                        found, role = keys_of(tokens, b, segments_of(starts[b + 1] - 1, num, den), kind)
                        keys.append(found)
                        roles.append(role)
                        sets.append(np.full(len(found), uid))
                if len(keys) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view("int64")), pa.array(np.concatenate(sets)), pa.array(np.concatenate(roles).astype("int8"))], names=["_k", "_uid", "_role"])
                    keys, sets, roles = [], [], []
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view("int64")), pa.array(np.concatenate(sets)), pa.array(np.concatenate(roles).astype("int8"))], names=["_k", "_uid", "_role"])

    return run


def _near(num: int, den: int):
    """Keep pairs whose sizes and coarse counts allow a link; rows (u, v, sizes, coarse counts)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            good = []
            for n, m, a, b in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4, 5)], strict=True):
                if min(n, m) * den < max(n, m) * num:
                    good.append(False)
                    continue
                a, b = np.frombuffer(a, "uint8"), np.frombuffer(b, "uint8")
                least = min(len(a), len(b))
                bound = int(np.abs(folded(a, least).astype("int32") - folded(b, least)).sum())
                # A count at the byte's limit says nothing.
                good.append(bound * (den + num) <= (den - num) * (n + m) or a.max() == 255 or b.max() == 255)
            good = np.array(good, bool)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good))], names=["_u", "_v"])

    return run


def _across(num: int, den: int):
    """Pairs of a key's sets in different components that may be linked; rows (key, salt, block a?, set, role, component, size, counts), by key."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def pairs(rows):
            columns = list(zip(*rows, strict=True))
            uid, role, comp, n, side = (np.array(c, "int64") for c in (columns[2], columns[3], columns[4], columns[5], columns[7]))
            counts = [np.frombuffer(c, "uint8") for c in columns[6]]
            lots = np.array([c.max() == 255 for c in counts])
            # A key's sets are of two neighbouring bands, so their numbers of classes differ by a factor of two at most.
            least = min(map(len, counts))
            coarse = np.array([folded(c, least) for c in counts], "int16")
            out_u, out_v = [], []
            for i in range(len(uid)):
                # A block meets itself once, another block once: sides tell which of two blocks a row is from.
                other = np.arange(i + 1, len(uid))
                other = other[(comp[other] != comp[i]) & ((side[other] != side[i]) | (side[i] == 2))]
                if not len(other):
                    continue
                ok = (((role[i] & PROBE) > 0) & ((role[other] & INDEX) > 0)) | (((role[i] & INDEX) > 0) & ((role[other] & PROBE) > 0))
                ok &= np.minimum(n[other], n[i]) * den >= np.maximum(n[other], n[i]) * num
                other = other[ok]
                bound = np.where(lots[other] | lots[i], 0, np.abs(coarse[other] - coarse[i]).sum(axis=1))
                other = other[bound * (den + num) <= (den - num) * (n[other] + n[i])]
                out_u.append(np.minimum(uid[other], uid[i]))
                out_v.append(np.maximum(uid[other], uid[i]))
            return out_u, out_v

        def emit(rows):
            u, v = pairs(rows)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["_u", "_v"])

        group, last = [], None
        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns)], strict=True):
                if row[:2] != last:
                    if len(group) > 1:
                        yield from emit(group)
                    group, last = [], row[:2]
                group.append(row)
        if len(group) > 1:
            yield from emit(group)

    return run


def shingles_of(text: bytes, size: int) -> frozenset:
    """The set itself: tuples of lower-case words (A to Z only are lowered)."""
    words = text.lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[k:] for k in range(size)], strict=False))


def _verify(size: int, num: int, den: int):
    """Pairs that are linked; rows (u, v, text of u, text of v)."""

    def run(batches):
        import pyarrow as pa

        held, mine = None, frozenset()
        for batch in batches:
            keep = []
            for u, a, b in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3)], strict=True):
                if u != held:
                    held, mine = u, shingles_of(a, size)
                other = shingles_of(b, size)
                common = len(mine & other)
                keep.append(common > 0 and den * common >= num * (len(mine) + len(other) - common))
            keep = pa.array(keep, "bool")
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["_u", "_v"])

    return run


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(_v, _c): the smallest vertex reachable from each vertex of ``edges`` (_u, _v), by smallest labels and shortcuts.

    A round takes the smallest label among a vertex's neighbours and then that label's own label, so paths
    shorten by half; it ends when nothing changes.
    """
    both = stage(edges.select("_u", "_v").union(edges.select(F.col("_v").alias("_u"), F.col("_u").alias("_v"))).distinct(), "links")
    labels = stage(both.groupBy("_u").agg(F.min("_v").alias("_m")).select(F.col("_u").alias("_v"), F.least("_u", "_m").alias("_c")), "labels")
    for _ in range(rounds):
        seen = both.join(labels, "_v").groupBy("_u").agg(F.min("_c").alias("_m"))
        near = labels.join(seen, labels["_v"] == seen["_u"]).select("_v", F.col("_c").alias("_was"), F.least("_c", "_m").alias("_c"))
        jump = labels.select(F.col("_v").alias("_c"), F.col("_c").alias("_cc"))
        labels = stage(join_one(near, jump, ["_c"]).select("_v", "_was", F.coalesce(F.least("_c", "_cc"), "_c").alias("_c")), "labels")
        changed = labels.where("_c <> _was").limit(1).count()
        labels = labels.select("_v", "_c")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", star_rounds: int = 2) -> DataFrame:
    """``docs`` (as struct ``_row``, text as ``_text``) with ``n_shingles, component_id, is_first``.

    A document's set holds its distinct shingles of ``size`` lower-case words; two are linked when
    ``den * intersection >= num * union``. ``component_id`` is the smallest id reachable by links;
    ``is_first`` marks one document per component, that with this id.

    Method. Equal sets are one class. Sizes fall in bands; in a band a set's tokens hash to one segment more than
    linked sets may differ in, so linked sets agree on a segment (``keys_of`` has the one-deletion neighbourhoods and the
    allocation by cost). Sets that share a segment key are candidates. Instead of all pairs of a key, first each set is compared with the key's
    central set, then, where a key still has several components, with another; what remains is compared across components, block by block
    in the tasks, and only pairs whose sizes and coarse counts allow a link leave them. All candidates are verified on the
    texts' words. So copies and near copies by the thousand cost a star each, and no link is lost.

    Defined cases: null or empty texts have 0 shingles and are components of their own; null ids come last
    as smallest ids; rows that repeat id and text share everything, and one of them is first; no rows give no
    rows; other columns are carried in ``_row``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_row"), F.col(id_col).alias("_id"), text.alias("_text"))
    rows = rows.withColumns({"_key": row_key(F.col("_id"), F.col("_text")), "_at": F.monotonically_increasing_id()})
    rows = text_table(rows, "_key", "jaccard")
    raw = rows.select("_key", F.col("_text").cast("binary").alias("_raw"))
    sets = raw.mapInArrow(_measure(size), "_key bigint, _n bigint, _one bigint, _two bigint, _coarse binary")
    sets = stage(join_one(sets, rows.groupBy("_key", "_id").agg(F.min("_at").alias("_at")), ["_key"]).dropDuplicates(["_key"]), "jaccard-sets")

    order = F.struct(F.col("_id").isNull().alias("_last"), F.col("_id"), F.col("_key"))
    classes = sets.where("_n > 0").groupBy("_n", "_one", "_two").agg(F.min(order).alias("_o")).select("_n", "_one", "_two", "_o._last", "_o._id", "_o._key")
    classes = stage(ranked(classes, ["_last", "_id", "_key"], name="_uid", purpose="jaccard-order"), "jaccard-classes")
    known = classes.select("_uid", "_key", F.col("_n").alias("_size")).join(sets.select("_key", "_coarse"), "_key")
    known = stage(known.select("_uid", "_size", "_coarse"), "jaccard-known")
    texts = raw.join(classes.select("_key", "_uid"), "_key")
    keys = texts.select("_uid", "_raw").mapInArrow(_index(size, num, den), "_k bigint, _uid bigint, _role tinyint")
    same = Window.partitionBy("_k")
    keys = keys.withColumns({"_least": F.min("_uid").over(same), "_most": F.max("_uid").over(same), "_rows": F.count("*").over(same), "_any": F.max(F.col("_role").bitwiseAND(PROBE)).over(same)})
    keys = stage(keys.where("_least < _most and _any > 0").select("_k", "_uid", "_role", "_rows"), "jaccard-keys")
    # The centre of a key's star: the set that meets the most others over all keys, such as the text that copies were made from.
    degrees = stage(keys.groupBy("_uid").agg(F.sum("_rows").alias("_degree")), "jaccard-degrees")
    centre = F.max(F.struct("_degree", F.negative("_uid").alias("_less"))).over(same)
    keys = stage(join_one(keys.drop("_rows"), degrees, ["_uid"]).withColumn("_centre", F.negative(centre["_less"])), "jaccard-keys")

    def linked(pairs: DataFrame) -> DataFrame:
        """Verified links among candidate pairs (_u < _v)."""
        pairs = pairs.where("_u < _v").distinct()
        one, two = (known.toDF(f"_{x}", f"_n{x}", f"_c{x}") for x in "uv")
        pairs = join_one(join_one(pairs, one, ["_u"]), two, ["_v"]).select("_u", "_v", "_nu", "_nv", "_cu", "_cv")
        pairs = stage(pairs.mapInArrow(_near(num, den), "_u bigint, _v bigint"), "jaccard-pairs")
        wanted = pairs.select(F.col("_u").alias("_uid")).union(pairs.select("_v")).distinct().join(classes.select("_uid", "_key"), "_uid")
        some = stage(raw.join(wanted, "_key").select("_uid", "_raw").dropDuplicates(["_uid"]), "jaccard-texts")
        ready = join_one(join_one(pairs, some.toDF("_v", "_b"), ["_v"]), some.toDF("_u", "_a"), ["_u"])
        ready = ready.select("_u", "_v", "_a", "_b").sortWithinPartitions("_u")
        return stage(ready.mapInArrow(_verify(size, num, den), "_u bigint, _v bigint"), "jaccard-links")

    star = lambda rows: rows.select(F.least("_centre", "_uid").alias("_u"), F.greatest("_centre", "_uid").alias("_v"))
    links = linked(star(keys))
    found = components(links)
    for turn in range(star_rounds):
        mixed = _mixed(keys, found)
        if turn + 1 < star_rounds:
            # Another centre: the first by degree outside the component that the key's first centre is in.
            inner = F.max(F.when(F.col("_uid") == F.col("_centre"), F.col("_c"))).over(same)
            outer = F.when(F.col("_c") != F.col("_inner"), F.struct("_degree", F.negative("_uid").alias("_less")))
            others = mixed.withColumn("_inner", inner).withColumn("_other", F.max(outer).over(same))
            others = others.withColumn("_centre", F.negative(F.col("_other._less")))
            more = linked(star(others.where("_c <> _inner")))
        else:
            # One copy of a row for each block that its own block has to meet.
            blocks = F.ceil(F.col("_rows") / BLOCK).cast("int")
            mixed = mixed.withColumns({"_blocks": blocks, "_mine": F.pmod(F.xxhash64("_uid"), blocks).cast("int")})
            met = mixed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            met = met.withColumns({"_salt": F.least("_mine", "_other") * F.col("_blocks") + F.greatest("_mine", "_other"), "_side": F.when(F.col("_mine") == F.col("_other"), 2).when(F.col("_mine") < F.col("_other"), 0).otherwise(1)})
            met = join_one(met.select("_k", "_salt", "_uid", "_role", "_c", "_side"), known, ["_uid"])
            met = met.repartition("_k", "_salt").sortWithinPartitions("_k", "_salt")
            more = linked(met.select("_k", "_salt", "_uid", "_role", "_c", "_size", "_coarse", "_side").mapInArrow(_across(num, den), "_u bigint, _v bigint"))
        links = stage(links.union(more), "jaccard-links")
        found = components(links)

    # Back from sets to documents: labels are ranks of first ids, so the smallest label has the smallest id.
    names = classes.select(F.col("_uid").alias("_c"), F.col("_id").alias("component_id"), F.col("_key").alias("_first_key"))
    by_set = join_one(classes.select("_n", "_one", "_two", "_uid"), found.toDF("_uid", "_c"), ["_uid"]).withColumn("_c", F.coalesce("_c", "_uid"))
    by_set = stage(join_one(by_set, names, ["_c"]).select("_n", "_one", "_two", "component_id", "_first_key"), "jaccard-result")
    by_row = stage(join_one(sets.select("_key", "_n", "_one", "_two", F.col("_at").alias("_first_at")), by_set, ["_n", "_one", "_two"]).drop("_one", "_two"), "jaccard-rows")
    out = rows.join(by_row, "_key")
    alone = F.col("_n") == 0
    first = (alone | (F.col("_first_key") == F.col("_key"))) & (F.col("_at") == F.col("_first_at"))
    return out.select("_row", "_text", F.col("_n").alias("n_shingles"), F.when(alone, F.col("_id")).otherwise(F.col("component_id")).alias("component_id"), first.alias("is_first"))


def _mixed(keys: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of keys whose sets are in several components, with the component, the smallest one and the number of rows."""
    same = Window.partitionBy("_k")
    rows = join_one(keys, found.toDF("_uid", "_c"), ["_uid"]).withColumn("_c", F.coalesce("_c", "_uid"))
    rows = rows.withColumns({"_least": F.min("_c").over(same), "_most": F.max("_c").over(same), "_rows": F.count("*").over(same)})
    return stage(rows.where("_least < _most").drop("_most"), "jaccard-mixed")


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents by four-word shingles and a Jaccard similarity of 0.85."""
    found = jaccard_components(documents(spark, folder).select("doc_id", "text"), size=4, num=85, den=100)
    return found.select("_row.doc_id", "n_shingles", "component_id")
