"""Sharding by balanced label propagation; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, query, ranked, stage


def _quotas(wanted: dict[tuple[int, int, int], int], free: dict[int, dict[tuple[int, int], int]], shards: int):
    """Moves allowed from s to t, and, by shard t, who goes back: runs (first place, end, s) in t's order of payers.

    ``wanted`` counts movers by source, target and class (bits of their group's size); ``free`` counts payers
    by shard, class and whether others of the group lie elsewhere; class 0 is not linked. Opposite moves pay
    for each other, largest classes first. The others, largest first, are paid by unlinked documents and then by smaller groups;
    groups of two or three that lie together also pay for groups of that size. The numbers are bounded by shards squared times bits.
    """
    total: dict[tuple[int, int], int] = {}
    for (s, t, _), n in wanted.items():
        total[s, t] = total.get((s, t), 0) + n
    moves = {(s, t): min(n, total.get((t, s), 0)) for (s, t), n in total.items()}
    paid, used, runs = dict(moves), dict.fromkeys(range(shards), 0), {}
    for s, t, k in sorted(wanted, key=lambda w: (-w[2], w[0], w[1])):
        swapped = min(wanted[s, t, k], paid[s, t])
        paid[s, t] -= swapped
        allowed = sum(n for (c, broken), n in free.get(t, {}).items() if c < k or (c == k == 2 and not broken))
        extra = min(wanted[s, t, k] - swapped, max(allowed - used[t], 0))
        if extra:
            moves[s, t] += extra
            mine = runs.setdefault(t, [])
            if mine and mine[-1][2] == s:
                mine[-1] = (mine[-1][0], used[t] + extra, s)
            else:
                mine.append((used[t], used[t] + extra, s))
            used[t] += extra
    return {pair: n for pair, n in moves.items() if n}, runs


def _by_pair(values: dict, source, target, default=0):
    out = F.lit(default)
    for (s, t), n in sorted(values.items()):
        out = F.when((source == s) & (target == t), F.lit(n)).otherwise(out)
    return out


def propagate(labels: DataFrame, members: DataFrame, shards: int, rounds: int | None = None) -> DataFrame:
    """Balanced label propagation: ``labels`` (_v, _shard) and ``members`` (_v, _link) give new labels, counts unchanged.

    Documents with a common ``_link`` are linked. In a round each document counts its neighbours (and
    itself) by shard and wants to move to the shard with most of them, if that is more than where it
    is; among equals, the one that a hash of the link names, which is the same for the whole group. Votes are summed per link, never per pair, and added over a document's links. A shard that
    holds nothing but a link's documents is no target for it, so that a group larger than a shard goes on to the next one. The driver sees
    counts per pair of shards and class of size and answers with quotas; documents of the largest groups and gains fill them,
    links kept together. Unlinked documents pay for moves, then documents of smaller groups, each group as a block.

    Rounds go on while they lower the cut (pairs of linked documents in different shards). A round that does not is taken back and tried
    again, first without shards in which nobody can pay for a group of that size, then without linked payers.
    """
    sizes = {r["_shard"]: r["n"] for r in labels.groupBy("_shard").agg(F.count("*").alias("n")).collect()}
    every = range(shards)
    idle = stage(labels.select("_v").join(members.select("_v").distinct(), "_v", "left_anti"), "shard-idle-rows")
    best, most, mode, low, turn = None, -1, 0, dict.fromkeys(range(shards), 0), 0
    while True:
        here = stage(members.join(labels, "_v"), "shard-members")
        votes = stage(here.groupBy("_link").agg(*[F.count_if(F.col("_shard") == s).alias(f"_n{s}") for s in every]), "shard-votes")
        together = votes.agg(F.sum(sum((F.col(f"_n{s}") * F.col(f"_n{s}") for s in every), F.lit(0)))).first()[0] or 0
        if together > most:
            best, most, mode = (labels, here, votes), together, 0
        else:
            mode += 1
        while True:
            if mode > 2 or turn == rounds:
                return best[0]
            labels, change, low = _round(*best, idle, sizes, low, mode, shards)
            if change:
                break
            mode += 1
        turn += 1


def _round(labels, here, votes, idle, sizes, low, mode, shards):
    """New labels, whether any document moves, and the least class of the payers in each shard."""
    every = range(shards)
    open_ = [F.when(F.col(f"_n{s}") < sizes.get(s, 0), F.col(f"_n{s}")).alias(f"_o{s}") for s in every]
    cast = here.join(votes.select("*", *open_), "_link").groupBy("_v", "_shard")
    cast = cast.agg(F.min("_link").alias("_link"), *[F.sum(f"_{x}{s}").alias(f"_{x}{s}") for x in "no" for s in every])
    stay = F.element_at(F.array(*[F.col(f"_n{s}") for s in every]), F.col("_shard") + 1)
    cast = cast.withColumns({"_stay": stay, "_all": sum((F.col(f"_n{s}") for s in every), F.lit(0))}).withColumn("_class", F.length(F.bin("_all")))
    entry = [F.lit(mode != 1) | (F.col("_class") > low[s]) | (F.col("_shard") == s) for s in every]
    votes_for = [F.when(F.col(f"_o{s}").isNotNull() & entry[s], F.struct(F.col(f"_o{s}").alias("n"), F.xxhash64("_link", F.lit(s)).alias("tie"), F.lit(s).alias("s"))) for s in every]
    cast = cast.withColumn("_best", F.array_max(F.array(*votes_for)))
    moving = F.coalesce((F.col("_best.n") >= F.col("_stay")) & (F.col("_best.n") > 0) & (F.col("_best.s") != F.col("_shard")), F.lit(False))
    state = cast.select("_v", "_shard", "_link", "_class", "_all", (F.col("_stay") < F.col("_all")).cast("int").alias("_broken"), moving.alias("_moving"), F.col("_best.s").alias("_to"), (F.col("_best.n") - F.col("_stay")).alias("_gain"))
    state = stage(state, "shard-movers")
    movers = state.where("_moving")
    wanted = {(r["_shard"], r["_to"], r["_class"]): r["n"] for r in movers.groupBy("_shard", "_to", "_class").agg(F.count("*").alias("n")).collect()}
    if not wanted:
        return labels, False, low
    payers = labels.join(idle, "_v", "left_semi").select("_v", "_shard", *[F.lit(0).alias(c) for c in ("_class", "_broken", "_all")], F.lit(None).cast(state.schema["_link"].dataType).alias("_link"))
    if mode < 2:
        payers = payers.unionByName(state.where("not _moving").select(*payers.columns))
    free: dict[int, dict[tuple[int, int], int]] = {}
    for r in payers.groupBy("_shard", "_class", "_broken").agg(F.count("*").alias("n")).collect():
        free.setdefault(r["_shard"], {})[r["_class"], r["_broken"]] = r["n"]
    moves, runs = _quotas(wanted, free, shards)
    if mode == 0:
        low = {t: min((c for c, _ in free.get(t, {})), default=64) for t in every}
    if not moves:
        return labels, False, low
    total: dict[tuple[int, int], int] = {}
    for (s, t, _), n in wanted.items():
        total[s, t] = total.get((s, t), 0) + n
    if moves != total:
        movers = ranked(movers, [F.desc("_class"), F.desc("_gain"), F.col("_link"), F.col("_v")], ["_shard", "_to"], purpose="shard-rank")
        movers = movers.where(F.col("_rank") < _by_pair(moves, F.col("_shard"), F.col("_to")))
    change = movers.select("_v", "_to")
    if runs:
        payers = payers.where(F.col("_shard").isin([*runs]))
        payers = ranked(payers, [F.col("_class"), F.col("_broken"), F.col("_all"), F.col("_link"), F.col("_v")], ["_shard"], purpose="shard-payers")
        to = F.lit(None).cast("int")
        for t, mine in sorted(runs.items()):
            back = F.lit(None).cast("int")
            for first, end, s in mine:
                back = F.when((F.col("_rank") >= first) & (F.col("_rank") < end), F.lit(s)).otherwise(back)
            to = F.when(F.col("_shard") == t, back).otherwise(to)
        change = change.union(payers.withColumn("_to", to).where("_to is not null").select("_v", "_to"))
    return stage(labels.join(change, "_v", "left").select("_v", F.coalesce("_to", "_shard").alias("_shard")), "shard-labels"), True, low


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int | None = None, id_col: str = "doc_id", text_col: str = "text", links: DataFrame | None = None) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``; counts of shards differ by one at most.

    Documents, numbered in order of id, are dealt out in turn; then linked documents move together
    by ``propagate``, in ``rounds`` at most or while that lowers the cut. Every move is paid with a move back, so the counts of the first deal hold
    throughout. ``links`` (id, link) may name any groups of linked documents; by default equal texts
    are linked. ``slot`` numbers a shard's documents in order of id from 0.

    Texts are read once and never shuffled, only their digests are. A group of copies with a third
    of the rows is summed before its shuffle; larger than a shard, it fills several.

    Defined cases: null text has size 1, checksum 0 and counts as an empty text; null ids come last and are never linked by
    ``links``; rows with equal id and text are separate documents of one group; no rows give no rows;
    other columns are left out, and cannot clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("_text"),
    )
    base = stage(ranked(base, [F.col("doc_id").asc_nulls_last(), F.col("_text")], name="_v", purpose="shard-base"), "shard-rows")
    labels = stage(base.select("_v", (F.col("_v") % shards).cast("int").alias("_shard")), "shard-labels")
    if links is None:
        members = base.select("_v", F.col("_text").alias("_link"))
    else:
        pairs = links.toDF("_id", "_link")
        members = base.join(pairs, base["doc_id"] == pairs["_id"]).select("_v", "_link").distinct()
    shared = stage(members.groupBy("_link").agg(F.count("*").alias("_n")).where("_n > 1").select("_link"), "shard-links")
    members = stage(members.join(shared, "_link"), "shard-linked")
    labels = propagate(labels, members, shards, rounds)
    out = ranked(base.join(labels, "_v"), [F.col("_v")], ["_shard"], name="slot", purpose="shard-slots")
    return out.select("doc_id", "size", "text_crc32", F.col("_shard").alias("shard"), "slot")


@query("op5_balanced_shards")
def op5_balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of equal counts, equal texts together."""
    placed = shard_documents(documents(spark, folder))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
