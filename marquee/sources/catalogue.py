"""Readers for the catalogue CSV, score lists and key sets."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.text import na_to_null
from marquee.operators.quality import ExpectationFailed, missing_columns
from marquee.operators.sizing import MAX_BROADCAST_ROWS
from marquee.schemas import CATALOGUE_COLUMNS

_SLASHES = re.compile("^([A-Za-z0-9]+):/+")  # the same file may be named with one slash or three
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a task in its low bits


def read_catalogue(spark: SparkSession, path: str, required: Sequence[str] = CATALOGUE_COLUMNS) -> DataFrame:
    """All columns as text, missing-value tokens as null, and `ordinal`, the row's place in file name and row order.

    A file is read by one task because texts may hold line breaks; large catalogues come as many files. All files have
    the header of the first; one with other names, or the same in another order, is an error when it is read.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    raw = reader.schema(reader.csv(path).schema).option("enforceSchema", False).csv(path)
    lost = missing_columns(raw, required)
    if lost:
        raise ExpectationFailed(f"columns missing from {path}: {lost}")
    files = sorted(_SLASHES.sub(r"\1:/", f) for f in raw.inputFiles())
    numbers = spark.createDataFrame(list(zip(files, range(len(files)))), "_file STRING, _number BIGINT")
    placed = raw.select(
        *[na_to_null(F.col(f"`{c}`")).alias(c) for c in required],
        F.regexp_replace("_metadata.file_path", _SLASHES.pattern, "$1:/").alias("_file"),
        F.monotonically_increasing_id().alias("_row"),
    )
    in_file = F.col("_row").bitwiseAND((1 << _ROW_BITS) - 1)
    number = F.coalesce("_number", F.raise_error(F.concat(F.lit("file without a number: "), "_file")).cast("bigint"))
    ordinal = F.shiftleft(number, _ROW_BITS) + in_file
    if len(files) <= MAX_BROADCAST_ROWS:
        numbers = F.broadcast(numbers)
    return placed.join(numbers, "_file", "left").select(*required, ordinal.alias("ordinal"))


def _whole_object(spark: SparkSession, path: str, value_type: str) -> DataFrame:
    """(key, value, place) of the entries of JSON objects; a broken object is an error. `place` orders them by file."""
    text = spark.read.option("wholetext", True).text(path).select("value", F.col("_metadata.file_path").alias("file"))
    entries = F.map_entries(F.from_json("value", f"map<string,{value_type}>", {"mode": "FAILFAST"}))
    placed = text.select("file", F.posexplode(entries).alias("at", "entry"))
    return placed.select("entry.key", "entry.value", F.struct("file", "at").alias("place"))


def _last(lists: DataFrame, key: str, value: str) -> DataFrame:
    """Of a key that comes again, the last value as a whole."""
    return lists.groupBy(F.col(key).alias("film")).agg(F.max_by(value, "place").alias("value"))


def read_score_map(spark: SparkSession, path: str) -> DataFrame:
    """`{key: [numbers]}` to (film, sample_index, score); keys with an empty list keep one row without a score, and of a
    repeated key the last list counts. A broken file is an error."""
    return explode_scores(_last(_whole_object(spark, path, "array<double>"), "key", "value"), "value")


def read_score_lines(spark: SparkSession, path: str) -> DataFrame:
    """One `{"id": ..., "scores": [...]}` per line: the form to use when the lists no longer fit one file."""
    rows = spark.read.schema("id STRING, scores ARRAY<DOUBLE>").option("mode", "FAILFAST").json(path)
    place = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id())
    return explode_scores(_last(rows.select("id", "scores", place.alias("place")), "id", "scores"), "value")


def explode_scores(lists: DataFrame, column: str) -> DataFrame:
    """Array per film to rows, numbered from 1."""
    return lists.select("film", F.posexplode_outer(column).alias("pos", "score")).select(
        "film", (F.col("pos") + 1).alias("sample_index"), "score"
    )


def read_key_set(spark: SparkSession, path: str) -> DataFrame:
    """Keys of `{key: null}` as one column `id`. A broken file is an error: it must not look like an empty list."""
    return _whole_object(spark, path, "string").select(F.col("key").alias("id")).distinct()


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json") -> DataFrame:
    """The rows at the path; none when nothing is there, and broken records are left out."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    try:
        if fmt in ("json", "csv"):
            reader = spark.read.schema(with_corrupt).option("mode", "PERMISSIVE")
            rows = reader.option("columnNameOfCorruptRecord", "_corrupt").format(fmt).load(path)
            return rows.filter(F.col("_corrupt").isNull()).drop("_corrupt")
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
