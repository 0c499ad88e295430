"""Dimension tables: name to surrogate id, created in order of first appearance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.dedupe import first_wins
from marquee.operators.ordering import split_points, with_running_totals, with_slot
from marquee.session import materialise


def extend_dimension(
    mentions: DataFrame,
    existing: DataFrame | None = None,
    order: Sequence[str] = ("ordinal",),
    parts: int | None = None,
) -> DataFrame:
    """The dimension (id, name) after all names of `mentions` were looked up or created.

    Ids are dense and follow the order of first appearance. The new names are written once before they are numbered,
    so the mentions are read once and a lost executor cannot change an id. The numbering adds the size of the earlier slots of the
    first order column to the position within the slot, so no task numbers the whole dimension.
    """
    first = (
        mentions.filter(F.col("name").isNotNull())
        .groupBy("name")
        .agg(F.min(F.struct(*[F.col(c) for c in order])).alias("first"))
    )
    if existing is not None:
        first = first.join(existing.select("name"), "name", "left_anti")
    fresh = materialise(first).withColumn("_at", F.col(f"first.{order[0]}").cast("double")).withColumn("one", F.lit(1).cast("long"))
    slotted = with_slot(fresh, "_at", split_points(fresh, "_at", parts), "_slot")
    numbered = with_running_totals(
        slotted, {"earlier": "one"}, [F.col("first"), F.col("name")], bounded_slots=True
    )
    base = 0
    if existing is not None:
        base = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    created = numbered.select((F.col("earlier") + 1 + F.lit(base)).cast("long").alias("id"), "name")
    return created if existing is None else existing.select("id", "name").unionByName(created)


def link(mentions: DataFrame, dimension: DataFrame, id_column: str, order: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Bridge rows (film, id, ...) for the mentions, first mention per key."""
    ids = dimension.select(F.col("id").alias(id_column), "name")
    linked = mentions.join(ids, "name").select("movie_id", id_column, *extra, *order)
    keys = ["movie_id", id_column] + [c for c in extra if c == "role"]
    return first_wins(linked, keys, order).drop(*order)
