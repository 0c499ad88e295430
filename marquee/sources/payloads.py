"""Fields of stored API payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import date_from_parts, format_money, joined_names
from marquee.schemas import PAYLOAD_BOX_DDL, PAYLOAD_TITLE_DDL


def _money(c: Column) -> Column:
    return format_money(c["amount"], c["currency"])


def payload_fields(staged: DataFrame, key: str = "imdb_id", title: str = "title_json", box: str = "box_json") -> DataFrame:
    """One row per title with the formatted fields; a payload that is missing or broken gives nulls."""
    t, b = F.from_json(title, PAYLOAD_TITLE_DDL), F.from_json(box, PAYLOAD_BOX_DDL)
    parsed = staged.select(key, t.alias("t"), b.alias("b"))
    t, b = F.col("t"), F.col("b")
    end = b["weekendEndDate"]
    return parsed.select(
        key,
        joined_names(t["originCountries"]).alias("countries"),
        joined_names(t["spokenLanguages"]).alias("languages"),
        _money(b["productionBudget"]).alias("budget"),
        _money(b["worldwideGross"]).alias("worldwide_gross"),
        _money(b["domesticGross"]).alias("domestic_gross"),
        _money(b["openingWeekendGross"]).alias("opening_gross"),
        date_from_parts(end["year"], end["month"], end["day"]).alias("weekend_end_date"),
        t["metacritic"]["score"].alias("metascore"),
        t["plot"].alias("synopsis"),
    )
