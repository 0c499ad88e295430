"""Ranks and running totals over long orders, cut into slots so that no task sorts a whole group.

Split points come from approximate quantiles. Each split point is a slot of its own, so a value that many rows
share falls into a slot where all rows tie and nothing has to be sorted; the slots between points hold the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.sizing import broadcast_if_small
from marquee.session import materialise

MIN_PARTS, MAX_PARTS = 16, 2_000


def split_points(df: DataFrame, column: str, parts: int | None = None) -> list[float]:
    """At most `parts` + 1 distinct values of the column that cut it into even shares.

    By default there are as many parts as shuffle partitions, so the slots shrink with the size of the cluster.
    """
    if parts is None:
        parts = min(MAX_PARTS, max(MIN_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    shares = [i / parts for i in range(parts + 1)]
    found = df.select(F.col(column).cast("double").alias("x")).approxQuantile("x", shares, 0.25 / parts)
    return sorted({p + 0.0 for p in found})  # no negative zero


def with_slot(df: DataFrame, column: str, points: Sequence[float], slot: str, descending: bool = False) -> DataFrame:
    """Slot number in sort order; odd slots hold one value only, nulls come last."""
    last = 2 * len(points) + 2
    x = F.col(column).cast("double")
    if not points:
        return df.withColumn(slot, F.when(x.isNull(), F.lit(last)).otherwise(F.lit(0)))
    step = Bucketizer(
        splits=[float("-inf"), *points, float("inf")], inputCol="_slot_x", outputCol="_slot_b", handleInvalid="keep"
    )
    # the bucket search tells -0.0 from 0.0, SQL does not
    cut = step.transform(df.withColumn("_slot_x", F.when(x.isNull() | (x == 0), F.lit(0.0)).otherwise(x)))
    position = F.col("_slot_b").cast("int")
    values = F.array(*[F.lit(p) for p in points])
    on_point = (position >= 1) & (F.get(values, position - 1) == F.col("_slot_x"))
    number = F.when(on_point, 2 * position - 1).otherwise(2 * position)
    if descending:
        number = F.lit(2 * len(points)) - number
    return cut.withColumn(slot, F.when(x.isNull(), F.lit(last)).otherwise(number)).drop("_slot_x", "_slot_b")


def rank_in_group(
    df: DataFrame,
    by: str,
    order: str,
    key: str,
    out: str,
    descending: bool = True,
    parts: int | None = None,
    salts: int = 32,
) -> DataFrame:
    """SQL RANK with nulls last, where groups and ties may be large.

    Rows are written once with their slot, as slots are counted before they are used; then one shuffle on (group, slot, salt). Rows of a slot with one value, and nulls, all have the rank of the slot's
    first row, so they are spread by salt; only slots between points are sorted. Slots are cut by the value as a double. Long
    and wide decimal values may differ though their doubles are equal: they are compared as they are, and in a slot of one
    double each value has the count of those before it.
    """
    wide = _wide(df.schema[order].dataType)
    points = split_points(df, order, parts)
    slotted = materialise(with_slot(df, order, points, "_slot", descending))
    counts = slotted.groupBy(by, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(by).alias("_by"),
        F.col("_slot").alias("_of"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    tied = F.col(order).isNull() | (F.col("_slot") % 2 == 1)
    salt = F.when(tied, F.pmod(F.xxhash64(key), F.lit(salts))).otherwise(F.lit(0))
    x = F.col(order) if wide else F.col(order).cast("double")
    value = x.desc_nulls_last() if descending else x.asc_nulls_last()
    local = F.rank().over(Window.partitionBy(by, "_slot", "_salt").orderBy(value))
    if wide:
        local = F.when(tied, F.lit(1)).otherwise(local)
    placed = slotted.withColumn("_salt", salt).withColumn("_local", local)
    if wide:
        placed = _add_places_in_point(placed, slotted, by, order, descending)
    same = F.col(by).eqNullSafe(F.col("_by")) & (F.col("_slot") == F.col("_of"))
    joined = placed.join(broadcast_if_small(offsets), same, "left")
    return joined.withColumn(out, F.col("_local") + F.col("_before")).drop(
        "_slot", "_salt", "_local", "_by", "_of", "_before"
    )


def _wide(kind: T.DataType) -> bool:
    """Whether values of a type may differ though their doubles do not."""
    return isinstance(kind, T.LongType) or isinstance(kind, T.DecimalType) and kind.precision > 15


def _add_places_in_point(placed: DataFrame, slotted: DataFrame, by: str, order: str, descending: bool) -> DataFrame:
    """Adds to `_local`, in slots of one double, how many rows of the slot come before the value. The values are counted first,
    so a value that many rows share is one row of the join's smaller side."""
    points = slotted.filter((F.col("_slot") % 2 == 1) & F.col(order).isNotNull())
    counts = points.groupBy(F.col(by).alias("_pby"), F.col("_slot").alias("_pof"), F.col(order).alias("_pv")).agg(F.count(F.lit(1)).alias("_pn"))
    sort = F.col("_pv").desc() if descending else F.col("_pv").asc()
    earlier = Window.partitionBy("_pby", "_pof").orderBy(sort).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_pbefore", F.coalesce(F.sum("_pn").over(earlier), F.lit(0))).filter(F.col("_pbefore") > 0)
    same = F.col(by).eqNullSafe(F.col("_pby")) & (F.col("_slot") == F.col("_pof")) & (F.col(order) == F.col("_pv"))
    joined = placed.join(broadcast_if_small(counts), same, "left")
    return joined.withColumn("_local", F.col("_local") + F.coalesce("_pbefore", F.lit(0))).drop("_pby", "_pof", "_pv", "_pn", "_pbefore")


def with_running_totals(
    df: DataFrame,
    totals: dict[str, str],
    order: Sequence[Column],
    by: Sequence[str] = (),
    slot: str = "_slot",
    bounded_slots: bool = False,
) -> DataFrame:
    """For each `out: column`, the sum over the rows before this one in its group.

    Needs a slot column that follows the order. Slot totals give each slot its start, the sort stays within a slot.
    `bounded_slots` says that there are few (group, slot) pairs, so their totals may be broadcast after a count.
    """
    by = list(by)
    earlier = Window.partitionBy(*by).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*by, slot).agg(*[F.sum(c).alias(o) for o, c in totals.items()])
    starts = sums.select(
        *by, slot, *[F.coalesce(F.sum(o).over(earlier), F.lit(0)).alias(f"_start_{o}") for o in totals]
    )
    if bounded_slots:
        starts = broadcast_if_small(starts)
    within = Window.partitionBy(*by, slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"_local_{o}") for o, c in totals.items()])
    joined = local.join(starts, [*by, slot], "inner")
    keep = [c for c in df.columns if c != slot]
    return joined.select(*keep, *[(F.col(f"_local_{o}") + F.col(f"_start_{o}")).alias(o) for o in totals])


def numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Dense numbers from 0 in the order of the columns. The rows are written once, sorted by range; the size of each part,
    one row a part, gives the number its rows start from."""
    placed = materialise(df.orderBy(*order).withColumn(out, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(out), 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    starts = [(k, sum(n for _, n in sizes[:i])) for i, (k, _) in enumerate(sizes)]
    first = df.sparkSession.createDataFrame(starts, "_part long, _first long")
    dense = F.col("_first") + F.col(out) - F.shiftleft(F.col("_part"), 33)
    return placed.join(F.broadcast(first), part == F.col("_part")).withColumn(out, dense).drop("_part", "_first")
