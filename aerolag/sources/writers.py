"""CSV and Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.sources.readers import read_text_table


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    header: bool = True,
    files: int | None = None,
    partition_by: list[str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write one file per partition, or ``files`` files when the caller asks.

    ``files`` repartitions instead of coalescing, so only the final copy is
    limited to that many tasks and the work before it keeps its parallelism.
    """
    if files is not None:
        df = df.repartition(files)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def compact(spark: SparkSession, source: str, target: str, files: int) -> None:
    """Rewrite a headed CSV folder as ``files`` files in another folder."""
    write_table(read_text_table(spark, source), target, files=files)


MANIFEST = "_manifest"


def write_years(df: DataFrame, path: str, year: str = "YEAR") -> None:
    """Replace the years that ``df`` has in a table partitioned by year; other years stay as they are.

    Spark moves finished partitions into place at the end, so a failed write leaves the old year. The
    manifest beside the data has the rows of each year, counted in what was written.
    """
    spark = df.sparkSession
    replace = {"partitionOverwriteMode": "dynamic"}
    df.write.mode("overwrite").options(**replace).partitionBy(year).parquet(f"{path}/data")
    written = [row[0] for row in df.select(year).distinct().collect()]
    counted = spark.read.parquet(f"{path}/data").where(F.col(year).isin(written)).groupBy(year).agg(F.count("*").alias("rows"))
    counted.repartition(1).write.mode("overwrite").options(**replace).partitionBy(year).parquet(f"{path}/{MANIFEST}")


def read_years(spark: SparkSession, path: str) -> DataFrame:
    """The table of :func:`write_years`."""
    return spark.read.parquet(f"{path}/data")


def audit_years(spark: SparkSession, path: str, year: str = "YEAR") -> DataFrame:
    """(year, rows, found) per year: the rows of the manifest, and those that are there."""
    found = read_years(spark, path).groupBy(year).agg(F.count("*").alias("found"))
    return spark.read.parquet(f"{path}/{MANIFEST}").join(found, year, "full").select(year, "rows", "found")
