"""Nearest-in-time joins with a tolerance, without pair enumeration.

Both sides are reduced to distinct (key, second) first, so a hot key shrinks before any shuffle.
Time is then cut into buckets as wide as the tolerance: the nearest earlier point of a probe lies
in its own bucket or is the last point of the bucket before, the nearest later one in its own bucket
or is the first of the bucket after. Those two points are handed over to the neighbour buckets as
extra rows. A window over (key, bucket) therefore holds at most one row per second of the tolerance
per side, however many rows the key has, and no pair of rows is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.order import order_key
from shelfwise.operators.skew import combine

HOUR = 3600


def nearest(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_at: str,
    right_at: str,
    hi: int,
    lo: int = 0,
    payload: Column | None = None,
) -> DataFrame:
    """For each distinct (on, left_at): the right_at with lo <= |difference| <= hi, closest first.

    Times are whole seconds (bigint). Equal distances go to the later time. ``payload`` is an
    aggregate over the right rows of one key and second; it travels with the point, so nothing is
    joined back. Returns (on, left_at, right_at, payload); probes without a match are left out.
    """
    bucket = F.floor(F.col("_at") / F.lit(hi + 1)).alias("_bucket")

    points = right.where(F.col(right_at).isNotNull()).groupBy(*on, F.col(right_at).cast("bigint").alias("_at"))
    points = points.agg((F.lit(True) if payload is None else payload).alias("_load"))
    points = points.select(*on, bucket, F.struct("_at", "_load").alias("_point"))
    edges = points.groupBy(*on, "_bucket").agg(F.min("_point").alias("_first"), F.max("_point").alias("_last"))
    handed = edges.select(
        *on, F.explode(
            F.array(
                F.struct((F.col("_bucket") - 1).alias("_bucket"), F.col("_first").alias("_point")),
                F.struct((F.col("_bucket") + 1).alias("_bucket"), F.col("_last").alias("_point")),
            )
        ).alias("_e"),
    ).select(*on, "_e._bucket", "_e._point")
    known = points.unionByName(handed).withColumn("_at", F.col("_point._at"))

    probes = left.where(F.col(left_at).isNotNull()).select(*on, F.col(left_at).cast("bigint").alias("_probe")).distinct()
    if lo:
        # The search starts lo seconds away, earlier and later: two rows per probe.
        probes = probes.select("*", F.explode(F.array(F.lit(-lo), F.lit(lo))).alias("_side"))
    else:
        probes = probes.withColumn("_side", F.lit(0))
    probes = probes.withColumn("_at", F.col("_probe") + F.col("_side")).select("*", bucket)

    # At equal times points come before probes: NULL sorts first.
    # The number leads the window key: Spark sorts by it much faster than by text.
    group, first_points = Window.partitionBy("_bucket", *on), F.col("_probe").asc_nulls_first()
    passed = lambda order: F.last("_point", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    seen = known.unionByName(probes, allowMissingColumns=True)
    seen = seen.withColumn("_before", passed(group.orderBy("_at", first_points)))
    seen = seen.withColumn("_after", passed(group.orderBy(F.desc("_at"), first_points)))

    gap = lambda point: F.abs(F.col("_probe") - F.col(f"{point}._at"))
    usable = lambda point: F.when(
        gap(point).between(lo, hi), F.struct(gap(point).alias("_gap"), (-F.col(f"{point}._at")).alias("_late"), F.col(f"{point}._load"))
    )
    before = F.when(F.col("_side") <= 0, usable("_before"))
    after = F.when(F.col("_side") >= 0, usable("_after"))
    found = seen.where(F.col("_probe").isNotNull()).select(*on, F.col("_probe").alias(left_at), F.least(before, after).alias("_best"))
    found = found.where(F.col("_best").isNotNull())
    if lo:
        found = found.groupBy(*on, left_at).agg(F.min("_best").alias("_best"))
    columns = [(-F.col("_best._late")).alias(right_at)]
    if payload is not None:
        columns.append(F.col("_best._load").alias("payload"))
    return found.select(*on, left_at, *columns)


def nearest_batch(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_at: str,
    right_at: str,
    batch: str,
    hours: int = 48,
) -> DataFrame:
    """The batch nearest in time to each probe, at most ``hours`` away on either side.

    ``right`` carries (on, right_at, batch); several batches at one second resolve to the largest
    id. Returns (on, left_at, batch).
    """
    batches = combine(right, [*on, right_at, batch])
    hit = nearest(left, batches, on, left_at, right_at, hours * HOUR, payload=F.max(batch))
    return hit.select(*on, left_at, F.col("payload").alias(batch))


def band_nearest(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_at: str,
    right_at: str,
    values: list[str],
    prefer: list[str],
    lo_hours: int = 24,
    hi_hours: int = 48,
) -> DataFrame:
    """Values of the nearest right row of the same key, between lo and hi hours away.

    The nearest row is taken even where its values are NULL. Rows of one key and second are
    settled by ``prefer``, smallest first. Returns (on, left_at, values).
    """
    row = F.min_by(F.struct(*values), order_key(*prefer))
    hit = nearest(left, right, on, left_at, right_at, hi_hours * HOUR, lo_hours * HOUR, payload=row)
    return hit.select(*on, left_at, *[F.col(f"payload.{v}").alias(v) for v in values])
