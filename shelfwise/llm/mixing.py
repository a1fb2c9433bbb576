"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, query, stage, words

#: Resolution of the sampling key and of each of the two levels of its histogram.
KEY_BITS, LEVEL_BITS = 40, 10
#: Sources up to which the plan (one row per source) is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 10_000


def water_fill(df: DataFrame, group: Sequence[str], total: str, weight: str, cap: str, out: str) -> DataFrame:
    """Share ``total`` within each group by weight; shares stop at ``cap`` and the excess is shared anew by weight.

    Sorted by cap per weight, the capped items come first, so running sums give the level at which
    the rest is shared. One row per source, or per source and size class: small next to the rows.
    """
    ratio = F.when(F.col(weight) > 0, F.col(cap) / F.col(weight)).otherwise(F.lit(0.0))
    order = Window.partitionBy(*group).orderBy(ratio, weight, cap).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    left = F.col(total) - F.coalesce(F.sum(cap).over(order), F.lit(0.0))
    level = F.try_divide(left, F.sum(weight).over(whole) - F.coalesce(F.sum(weight).over(order), F.lit(0.0)))
    df = df.withColumn("_level", level).withColumn("_full", F.coalesce(F.col(cap) <= F.col(weight) * F.col("_level"), F.lit(True)))
    df = df.withColumn("_level", F.max(F.when(~F.col("_full"), F.col("_level"))).over(whole))
    return df.withColumn(out, F.when(F.col("_full"), F.col(cap)).otherwise(F.col(weight) * F.col("_level"))).drop("_level", "_full")


def log_length(size: Column) -> Column:
    """Inclusion weight 1 + floor(log2(size)): longer documents get more odds, but far less than in proportion."""
    return F.length(F.bin(F.greatest(size, F.lit(1))))


def _threshold(cells: DataFrame, rest: DataFrame, level: str) -> DataFrame:
    """Per source, the first cell at which the running size passes what is left, and what is left to be taken from it."""
    run = Window.partitionBy("_s").orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = cells.withColumn("_run", F.sum("_n").over(run)).join(rest, "_s").where("_run > _left")
    return passed.groupBy("_s").agg(F.min(F.struct(level, (F.col("_run") - F.col("_n")).alias("_before"), "_left")).alias("_c")).select(
        "_s", F.col(f"_c.{level}").alias(f"_at_{level}"), (F.col("_c._left") - F.col("_c._before")).alias("_left")
    )


def _place() -> Column:
    """Place of a document in the rank order of its source; no two rows of a pool share one."""
    return F.struct("_key", "_id", "_u", "_size")


def _pass(fitting: DataFrame, gaps: DataFrame, small) -> DataFrame:
    """Per source with a document that fits: the ``_last`` place up to which ``fitting`` is taken, and the gap ``_left`` after it."""
    cells = fitting.groupBy("_s", "_l1").agg(F.sum("_n").alias("_n"), F.max(_place()).alias("_top"))
    sums = cells.groupBy("_s").agg(F.sum("_n").alias("_sum"), F.max("_top").alias("_top"))
    first = _threshold(cells.drop("_top"), gaps, "_l1")
    second = fitting.join(small(first), "_s").where("_l1 = _at__l1")
    second = _threshold(second.groupBy("_s", "_l2").agg(F.sum("_n").alias("_n")), first.select("_s", "_left"), "_l2")
    run = Window.partitionBy("_s").orderBy(_place()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = fitting.join(small(second), "_s").where("_l2 = _at__l2").withColumn("_run", F.sum("_n").over(run)).where("_run <= _left")
    fits = fits.groupBy("_s").agg(F.max(_place()).alias("_in_cell"), F.max("_run").alias("_run"))
    # Up to the cell of the threshold everything is taken; in it, up to the last document that fits. A place with nulls lies before its key.
    place = fitting.select(_place().alias("_p")).schema["_p"].dataType
    start = F.struct(F.shiftleft("_at__l2", KEY_BITS - 2 * LEVEL_BITS).alias("_key"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in place.fields[1:]])
    cut = second.join(fits, "_s", "left").select("_s", F.coalesce("_in_cell", start).alias("_end"), (F.col("_left") - F.coalesce("_run", F.lit(0))).alias("_over"))
    out = sums.join(gaps, "_s").join(cut, "_s", "left")
    return out.select("_s", F.coalesce("_end", "_top").alias("_last"), F.coalesce("_over", F.col("_left") - F.col("_sum")).alias("_left"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_copies: int = 3,
    inclusion=log_length,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with a struct column ``_mix``: size, source_size, target, copies, taken.

    Sources in code point order, null last, take ``weights`` in turn and share the size of the whole
    corpus; a target stops at ``max_copies`` times its source's size, the excess is shared anew. In a
    source a document's expected copies are its inclusion weight times a factor, at most
    ``max_copies``, such that expected words meet the target. The whole part of the copies is certain.
    The rest is an inclusion probability p: with a uniform u drawn from a hash of id and text,
    documents are ranked by [u/(1-u)] / [p/(1-p)] and taken in this order up to the words that are
    left to the target (the sample's size is fixed in words). A document that does not fit is skipped,
    so what remains in the end is less than the smallest document that was not drawn.

    The rank key's histogram, two levels of 1024 cells per source, finds the threshold, so no window
    ever holds a source; only documents of one final cell are ranked exactly. It is found again over the
    later documents of at most the gap until no document fits in any source; a pass takes one at least
    and skips all that are too long at once. A source with a third of the rows is summed before its
    shuffle. The text itself is shuffled only to find skipped repeats where these are many.

    Defined cases: null or empty text has size 0 and is never taken; null sources are one source;
    a null id is an id; rows that repeat id and text share one draw, hence are taken together; no rows
    give no rows; other columns pass through (``_mix`` must be free).
    """
    u = (F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))
    fresh = {"_size": words(F.col(text_col)), "_u": u}
    base = stage(
        docs.select(F.col(source_col).alias("_source"), F.col(id_col).alias("_id"), *(c.alias(n) for n, c in fresh.items()))
        .groupBy("_source", "_id", "_size", "_u").agg(F.count("*").alias("_rows")),
        "mix",
    )
    number = Window.orderBy(F.col("_source").asc_nulls_last())
    sources = base.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_rows")).alias("_source_size"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_s") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("_s", F.row_number().over(number) - 1).withColumn("_w", turn)
    everything = Window.partitionBy()
    sources = sources.withColumn("_all", F.sum("_source_size").over(everything).cast("double")).withColumn("_cap", F.col("_source_size") * float(max_copies))
    sources = stage(water_fill(sources, (), "_all", "_w", "_cap", "_target").select("_source", "_s", "_source_size", "_target"), "mix-sources")

    # Tables of a row per source (or per source and size class) are broadcast where the sources are few.
    few = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    small = F.broadcast if few else (lambda df: df)
    rows = base.join(small(sources), base["_source"].eqNullSafe(sources["_source"])).where("_size > 0")
    rows = rows.select("_s", "_target", "_id", "_size", "_u", "_rows", inclusion(F.col("_size")).cast("long").alias("_w"))
    classes = rows.groupBy("_s", "_w").agg(F.sum(F.col("_size") * F.col("_rows")).cast("double").alias("_words"), F.max("_target").alias("_target"))
    classes = classes.withColumns({"_share": F.col("_w") * F.col("_words"), "_cap": F.col("_words") * float(max_copies)})
    classes = stage(water_fill(classes, ("_s",), "_target", "_share", "_cap", "_goal").select("_s", "_w", (F.col("_goal") / F.col("_words")).alias("_c")), "mix-classes")

    pool = _drawn(rows.join(small(classes), ["_s", "_w"]))
    left = pool.groupBy("_s").agg((F.max("_target") - F.sum(F.col("_whole") * F.col("_size") * F.col("_rows"))).alias("_left"))
    pool = pool.where("_key is not null").withColumn("_n", F.col("_size") * F.col("_rows"))
    pool = stage(pool.select("_s", "_id", "_u", "_size", "_n", "_key", (F.shiftright("_key", KEY_BITS - LEVEL_BITS)).alias("_l1"), F.shiftright("_key", KEY_BITS - 2 * LEVEL_BITS).alias("_l2")), "mix-pool")
    gaps = stage(left, "mix-left")
    fitting, steps = pool.join(small(gaps), "_s").where("_n <= _left").drop("_left"), []
    while True:
        passed = stage(_pass(fitting, gaps, small), "mix-pass")
        if passed.isEmpty():
            break
        steps.append(gaps.withColumnRenamed("_left", "_gap").join(passed.select("_s", "_last"), "_s"))
        gaps = passed.select("_s", "_left")
        # Earlier documents of at most the new gap fitted the gap before, hence are taken.
        fitting = stage(fitting.join(small(passed), "_s").where((F.col("_n") <= F.col("_left")) & (_place() > F.col("_last"))).drop("_left", "_last"), "mix-fitting")

    copies = classes.groupBy("_s").agg(F.map_from_entries(F.collect_list(F.struct("_w", "_c"))).alias("_copies"))
    plan = sources.join(copies, "_s", "left")
    if steps:
        taken = reduce(DataFrame.unionByName, steps)
        plan = plan.join(taken.groupBy("_s").agg(F.collect_list(F.struct("_gap", "_last")).alias("_steps")), "_s", "left")
    else:
        plan = plan.withColumn("_steps", F.lit(None))
    plan = stage(plan, "mix-plan")
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"), F.col(source_col).alias("_row_source"), *(c.alias(n) for n, c in fresh.items()))
    out = wide.join(small(plan), F.col("_row_source").eqNullSafe(F.col("_source")))
    out = _drawn(out.withColumn("_c", F.coalesce(F.element_at("_copies", inclusion(F.col("_size")).cast("long")), F.lit(0.0))))
    chosen = _chosen(F.col("_size")) if steps else F.lit(False)
    if steps:
        # A row does not know its repeats: those that fit alone, but not together, are marked.
        barred = pool.where("_n > _size").join(small(plan.select("_s", "_steps")), "_s").where(_chosen(F.col("_size")) & ~_chosen(F.col("_n")))
        barred = stage(barred.select(F.col("_s").alias("_s2"), F.col("_id").alias("_id2"), F.col("_u").alias("_u2"), F.col("_size").alias("_size2")), "mix-barred")
        rare = barred.limit(BROADCAST_SOURCES + 1).count()
        if rare:
            same = (F.col("_s") == F.col("_s2")) & F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_u") == F.col("_u2")) & (F.col("_size") == F.col("_size2"))
            out = out.join(F.broadcast(barred) if rare <= BROADCAST_SOURCES else barred.hint("shuffle_merge"), same, "left")
            chosen = chosen & F.col("_s2").isNull()
    taken = F.col("_whole") + chosen.cast("long")
    taken = F.when(F.col("_size") > 0, taken).otherwise(F.lit(0)).cast("long")
    mix = F.struct(
        F.col("_size").alias("size"), F.col("_source_size").cast("long").alias("source_size"), F.col("_target").alias("target"),
        taken.alias("copies"), (taken * F.col("_size")).alias("taken"),
    )
    out = out.select("_row", mix.alias("_mix"))
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns], "_mix")


def _drawn(df: DataFrame) -> DataFrame:
    """Whole copies, and the rank key of the fraction: q / (1 + q) for q = odds of u over odds of p; null where p is 0."""
    whole = F.floor(F.col("_c") + F.lit(1e-9))
    p, u = F.col("_c") - F.col("_whole"), F.col("_u")
    key = u * (1 - p) / (u * (1 - p) + p * (1 - u))
    return df.withColumn("_whole", whole).withColumn("_key", F.when(p > 1e-9, F.floor(key * F.lit(float(1 << KEY_BITS))).cast("long")))


def _chosen(words: Column) -> Column:
    """Does a document of so many words lie in one of its source's steps: at most the gap of a pass, and up to its last place?"""
    here = _place()
    inside = F.exists("_steps", lambda step: (words <= step["_gap"]) & (here <= step["_last"]))
    return F.col("_key").isNotNull() & F.coalesce(inside, F.lit(False))


@query("op1_mix_sources")
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that the mix takes from it."""
    mixed = mix_sources(documents(spark, folder))
    return mixed.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken", "_mix.copies", "source")
