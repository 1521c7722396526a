"""CSV sources. Cells are read as text by header name and cast leniently.

Reading by name keeps files apart from the column order of the schema, and CSV
column pruning still limits parsing to the columns a job selects.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag import schemas

WEATHER_DATE_FORMAT = "yyyyMMdd"
# Bytes that opening a file is said to cost, so that no task is given a second one.
ALONE = 1 << 40


def read_text_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headed CSV files or a folder of them as one table of text columns.

    Files that share a header are one scan; files with other columns, or the same in another order,
    are joined by name, and columns that a file lacks are null.
    """
    groups = _by_header(spark, [path] if isinstance(path, str) else path)
    # Should a file change meanwhile, its header is checked against the group's.
    reader = spark.read.option("header", True).option("enforceSchema", False)
    tables = [reader.csv(files) for files in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task, if it is where its file begins; nothing more is read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, header) of every file under ``paths`` that has a line, from one job.

    A session of its own gives each file tasks of its own, whose first line arrives alone, so that
    of a file one buffer is read however long it is.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.files.openCostInBytes", str(ALONE))
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = session.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("header"), F.col("_metadata.file_block_start").alias("at")
    )
    first = lines.mapInArrow(_first_lines, "path string, header string, at bigint")
    return first.where("at = 0").select("path", "header")


def _by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files under ``paths``, those of equal first lines together.

    Files without a line have no rows and are left out, unless there are no others.
    """
    groups: dict[str, list[str]] = {}
    for row in sorted(headers(spark, paths).collect()):
        groups.setdefault(row["header"], []).append(unquote(row["path"]))
    return list(groups.values()) or [paths]


def typed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The declared columns that exist, cast; integers may be written as decimals."""
    kept = []
    for name, kind in columns.items():
        if name in df.columns:
            cell = F.col(name)
            if kind == "int":
                cell = cell.try_cast("double")
            kept.append(cell.try_cast(kind).alias(name))
    return df.select(*kept)


def read_flights(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One file, several, or a folder of yearly files, joined by column name."""
    return typed(read_text_table(spark, path), schemas.FLIGHTS)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    return typed(read_text_table(spark, path), schemas.AIRPORTS)


def read_airports_stations(spark: SparkSession, path: str) -> DataFrame:
    return typed(read_text_table(spark, path), schemas.AIRPORTS_STATIONS)


def read_carriers(spark: SparkSession, path: str) -> DataFrame:
    return typed(read_text_table(spark, path), schemas.CARRIERS)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Headerless: the first three columns are station, latitude, longitude."""
    return spark.read.schema(schemas.STATIONS).option("header", False).csv(path)


def read_weather(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per station, day and element; the day is parsed once, here."""
    text = read_text_table(spark, path)
    return text.select(
        "STATION_ID",
        F.try_to_timestamp(F.col("DATE"), F.lit(WEATHER_DATE_FORMAT)).cast("date").alias("OBS_DATE"),
        "ELEMENT",
        F.col("DATA_VALUE").try_cast("double").alias("DATA_VALUE"),
    )


def read_training_rows(spark: SparkSession, path: str | list[str], header: bool = False) -> DataFrame:
    """Encoded rows of nine integers; 0 stands for an unknown carrier type or area, as when written."""
    names = schemas.TRAINING_ROW.fieldNames()
    text = spark.read.schema(", ".join(f"{name} string" for name in names))
    rows = text.option("header", header).csv(path)
    return rows.select(*[F.coalesce(F.col(n).try_cast("int"), F.lit(0)).alias(n) for n in names])


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Name the tables for ``spark.sql``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
