"""How many different things a key reaches through what it is linked to: earlier successes of a film's people, co-workers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.ordering import numbered
from marquee.session import materialise

#: Links beyond which a person (or film) is counted through sets of such people instead of being joined row by row.
HOT = HOT_PERSON = 500
#: Sets of up to so many busy vias are counted by their subsets; longer ones through bitmaps.
FEW = 6
#: Lists of a key that are put together to be counted; each has at most as many items as a via that is not busy.
LISTS = 16


def distinct_reached(mine: DataFrame, theirs: DataFrame, keys: Sequence[str], hot: int = HOT, few: int = FEW) -> DataFrame:
    """(*keys, n): the number of different items that a key reaches. Keys that reach none may be missing.

    `mine`: the keys, via, year; `theirs`: via, item, then. An item counts if `then`, a property of the item, is below `year`,
    a property of the keys.

    A via with few items is joined row by row: the key's row meets one list of at most `hot` items, and lists are shuffled by
    key once. Items that the key reaches through a busy via as well are dropped in the join, by comparing the sets of busy vias
    of both. Through busy vias, keys with the same set are one and items with the same set and `then` are one: for each
    subset of up to `few` vias the items that have all of it are counted, and inclusion and exclusion over the subsets of
    a key's set gives the items that have any of it. Keys or items in more busy vias than that are counted by bitmaps, one
    for each via and block of items. So no two keys and no two items of a busy via ever meet. All ways are exact.
    """
    keys = list(keys)
    theirs = materialise(theirs.select("via", "item", "then").filter(F.col("via").isNotNull()).distinct())
    busy = materialise(theirs.groupBy("via").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("via"))
    if busy.isEmpty():
        lists = theirs.groupBy("via").agg(F.collect_list(F.struct("then", "item")).alias("items"))
        met = mine.join(lists, "via").select(*keys, F.filter("items", lambda x: x["then"] < F.col("year"))["item"].alias("items"))
        return _counted(met, keys)
    their_busy = theirs.join(busy, "via", "left_semi")
    sets = materialise(mine.join(busy, "via", "left_semi").groupBy(*keys, "year").agg(F.array_sort(F.collect_set("via")).alias("set")))
    crowds = materialise(their_busy.groupBy("item", "then").agg(F.array_sort(F.collect_set("via")).alias("of")))
    many_mine = not sets.filter(F.size("set") > few).isEmpty()
    many_theirs = not crowds.filter(F.size("of") > few).isEmpty()

    apart = _apart(mine, theirs, busy, sets, crowds, keys, few, many_mine or many_theirs).withColumnRenamed("n", "a")

    crews = sets.select("set").distinct()
    crowded = crowds.filter(F.size("of") > few).select("item", "then", F.explode("of").alias("via"))
    parts = [
        _hits_by_subsets(crews.filter(F.size("set") <= few), crowds.filter(F.size("of") <= few)),
        _hits_by_bitmaps(crews.filter(F.size("set") <= few), crowded),
    ]
    if many_mine:
        parts.append(_hits_by_bitmaps(crews.filter(F.size("set") > few), their_busy))
    asked = sets.select("set", "year").distinct().withColumn("hits", F.lit(0).cast("long"))
    per_year = reduce(DataFrame.unionByName, [*parts, asked]).groupBy("set", "year").agg(F.sum("hits").alias("hits"))
    before = Window.partitionBy("set").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    reached = per_year.withColumn("b", F.coalesce(F.sum("hits").over(before), F.lit(0))).drop("hits")
    through_busy = sets.join(reached, ["set", "year"]).select(*keys, "b")
    total = F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))
    return apart.join(through_busy, keys, "full").select(*keys, total.alias("n")).filter(F.col("n") > 0)


def _unlisted(met: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct (*keys, item) of rows (*keys, items): one shuffle by the keys, of lists that are only unfolded after it."""
    by_key = met.filter(F.size("items") > 0).repartition(*keys)
    return by_key.select(*keys, F.explode("items").alias("item")).distinct()


def _counted(met: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, n): the number of distinct items of rows (*keys, items). Lists are shuffled by the keys once; those of a key with
    up to `LISTS` become one list there, only those of the others are unfolded."""
    own = Window.partitionBy(*keys)
    by_key = met.filter(F.size("items") > 0).repartition(*keys).withColumn("_row", F.monotonically_increasing_id())
    sized = by_key.select("*", F.count(F.lit(1)).over(own).alias("_lists"), F.min("_row").over(own).alias("_first"))
    few = F.col("_lists") <= LISTS
    joined = sized.withColumn("_all", F.collect_list(F.when(few, F.col("items"))).over(own)).filter(~few | (F.col("_row") == F.col("_first")))
    nothing = F.array(F.lit(None).cast(met.schema["items"].dataType.elementType))
    distinct = F.size(F.array_distinct(F.flatten("_all")))
    counted = joined.select(*keys, F.when(few, distinct).alias("_n"), F.when(few, nothing).otherwise(F.col("items")).alias("items"))
    unlisted = counted.select(*keys, "_n", F.explode("items").alias("item")).distinct()
    return unlisted.groupBy(*keys).agg(F.sum(F.coalesce("_n", F.lit(1))).alias("n"))


def _apart(
    mine: DataFrame, theirs: DataFrame, busy: DataFrame, sets: DataFrame, crowds: DataFrame, keys: Sequence[str], few: int, many: bool
) -> DataFrame:
    """(*keys, n): the number of items reached through vias that are not busy, but through no busy one. Sets of up to `few` vias travel
    with the rows that are joined; where one is longer (`many`: if there may be any), links are compared instead."""
    none = F.array().cast(sets.schema["set"].dataType)

    def carried(df, column, size):
        held = F.coalesce(F.col(column), none)
        return df.withColumns({column: F.when(F.size(held) <= few, held).otherwise(none), size: F.size(held)})

    own = carried(mine.join(busy, "via", "left_anti").join(sets, [*keys, "year"], "left"), "set", "n_set")
    rest = carried(theirs.join(busy, "via", "left_anti").join(crowds, ["item", "then"], "left"), "of", "n_of")
    lists = rest.groupBy("via").agg(F.collect_list(F.struct("then", "item", "of", "n_of")).alias("items"))
    joined = own.join(lists, "via")
    earlier = lambda x: (x["then"] < F.col("year")) & ~F.arrays_overlap(x["of"], F.col("set"))
    if not many:
        return _counted(joined.select(*keys, F.filter("items", earlier)["item"].alias("items")), keys)
    unsure = lambda x: (F.col("n_set") > 0) & (x["n_of"] > 0) & ((F.col("n_set") > few) | (x["n_of"] > few))
    settled = _unlisted(joined.select(*keys, F.filter("items", lambda x: earlier(x) & ~unsure(x))["item"].alias("items")), keys)
    pairs = _unlisted(joined.select(*keys, F.filter("items", lambda x: earlier(x) & unsure(x))["item"].alias("items")), keys)
    links = crowds.select("item", F.explode("of").alias("via"))
    shared = (
        pairs.join(sets.select(*keys, F.explode("set").alias("via")), keys)
        .join(links, ["item", "via"], "left_semi")
        .select(*keys, "item")
        .distinct()
    )
    return settled.unionByName(pairs.join(shared, [*keys, "item"], "left_anti")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _subsets(column: str) -> Column:
    """All subsets of an array but the empty one, in the order of its elements."""
    chosen = lambda mask: F.filter(column, lambda x, i: F.call_function("shiftright", mask, i) % 2 == 1)
    last = F.call_function("shiftleft", F.lit(1), F.size(column)) - 1
    return F.transform(F.sequence(F.lit(1), last), chosen)


def _hits_by_subsets(crews: DataFrame, crowds: DataFrame) -> DataFrame:
    """(set, year, hits): the items with `then` = year that have any via of the set, by inclusion and exclusion."""
    alike = crowds.groupBy("of", "then").agg(F.count(F.lit(1)).alias("n"))
    holding = alike.select("then", "n", F.explode(_subsets("of")).alias("part")).groupBy("part", "then").agg(F.sum("n").alias("n"))
    asked = crews.select("set", F.explode(_subsets("set")).alias("part"))
    signed = F.when(F.size("part") % 2 == 1, F.col("n")).otherwise(-F.col("n"))
    return asked.join(holding, "part").groupBy("set", F.col("then").alias("year")).agg(F.sum(signed).alias("hits"))


def _hits_by_bitmaps(crews: DataFrame, links: DataFrame) -> DataFrame:
    """The same for links (via, item, then): the bitmaps of a set are joined by or, and their bits counted, by block."""
    return (
        crews.select("set", F.explode("set").alias("via"))
        .join(item_bitmaps(links), "via")
        .groupBy("set", "then", "block")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
        .groupBy("set", F.col("then").alias("year"))
        .agg(F.sum(F.bitmap_count("bits")).alias("hits"))
    )


def item_bitmaps(links: DataFrame) -> DataFrame:
    """(via, then, block, bits) of links (via, item, then): the items of a via, numbered in the order of `then`, as bitmaps."""
    items = numbered(links.select("item", "then").distinct(), ["then", "item"], "number")
    placed = links.select("via", "item").join(items, "item")
    number = F.col("number") + 1
    return placed.groupBy("via", "then", F.bitmap_bucket_number(number).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )


def earlier_successes(
    films: DataFrame,
    involved: DataFrame,
    outputs: Mapping[str, str],
    success: str = "nominated_oscar",
    hot: int = HOT,
) -> DataFrame:
    """Per film and role, the number of distinct successful films of earlier years that share a person with it.

    The person counts in the named role for the film itself and in any role for the earlier film. `outputs` maps output
    column to role. Films without any such history are not in the result. `films`: imdb_id, release_year and the
    success flag; `involved`: movie_id, person_id, role. See `distinct_reached`.
    """
    summed = success_counts(films, involved, outputs, success, hot).groupBy("movie_id")
    return summed.agg(*[F.coalesce(F.sum(o), F.lit(0)).alias(o) for o in outputs])


def success_counts(
    films: DataFrame,
    involved: DataFrame,
    outputs: Mapping[str, str],
    success: str = "nominated_oscar",
    hot: int = HOT,
) -> DataFrame:
    """The same as partial counts, to be summed by film. Earlier films are numbered, as lists of numbers are shorter than lists
    of keys and cheaper to compare; the numbers are written out, so that a task done again has the same ones."""
    years = films.select(F.col("imdb_id").alias("movie_id"), F.col("release_year").alias("year"))
    people = involved.filter(F.col("role").isin(list(outputs.values()))).select("role", "movie_id", F.col("person_id").alias("via"))
    good = films.filter(F.col(success) & F.col("imdb_id").isNotNull()).groupBy("imdb_id").agg(F.collect_set(F.struct(F.col("release_year").alias("then"))).alias("thens"))
    good = materialise(good.withColumn("item", F.monotonically_increasing_id()))
    linked = involved.select(F.col("movie_id").alias("imdb_id"), F.col("person_id").alias("via")).join(good, "imdb_id")
    theirs = linked.select("item", "via", F.inline("thens"))
    counted = distinct_reached(people.join(years, "movie_id"), theirs, ["role", "movie_id"], hot)
    per_role = [F.when(F.col("role") == r, F.col("n")).alias(o) for o, r in outputs.items()]
    return counted.select("movie_id", *per_role)


def coworkers(involved: DataFrame, role: str | None = None, hot: int = HOT) -> DataFrame:
    """(person_id, coworkers): the number of other people in the films of a person, in those where they have `role` if it is
    given; the others count in any role. People who always work alone have 0. Rows without film or person are left out.

    A film with few people is joined row by row; the people of the others are bitmaps, and films are what people have in
    common. See `distinct_reached`."""
    known = involved.filter(F.col("movie_id").isNotNull() & F.col("person_id").isNotNull())
    own = known if role is None else known.filter(F.col("role") == role)
    mine = own.select("person_id", F.col("movie_id").alias("via"), F.lit(1).alias("year")).distinct()
    theirs = known.select(F.col("movie_id").alias("via"), F.col("person_id").alias("item"), F.lit(0).alias("then")).distinct()
    counted = distinct_reached(mine, theirs, ["person_id"], hot)
    return counted.select("person_id", (F.col("n") - 1).alias("coworkers"))  # everybody reaches themselves
