"""Casts and missing-value cleaning that hold under ANSI mode.

Text that is not a number becomes null instead of failing the job, and integers
go through double so that ``'-60.0'`` reads as -60.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that marks a missing cell wherever it occurs in the cell.
MISSING_MARKERS = ["None", "NULL"]
# Spellings of NaN; tested as text, since casting ordinary text to find out is slow.
NAN_TEXTS = ["nan", "+nan", "-nan"]


def as_double(name: str) -> Column:
    return F.col(name).try_cast("double")


def as_int(name: str) -> Column:
    return as_double(name).try_cast("int")


def is_nan(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(F.lower(F.trim(name)).isin(NAN_TEXTS), F.lit(False))
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.coalesce(F.isnan(name), F.lit(False))
    return F.lit(False)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null or NaN; for text also empty, or holding one of the markers."""
    missing = F.col(name).isNull() | is_nan(df, name)
    if isinstance(df.schema[name].dataType, T.StringType):
        missing = missing | (F.col(name) == "")
        for marker in MISSING_MARKERS:
            missing = missing | F.contains(F.col(name), F.lit(marker))
    return missing


def clean_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing cells become 0, as text in text columns; columns of other kinds stay."""
    cleaned = []
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        cell = F.col(name)
        if isinstance(kind, (T.StringType, T.NumericType)):
            cell = F.when(is_missing(df, name), F.lit("0").cast(kind)).otherwise(cell).alias(name)
        cleaned.append(cell)
    return df.select(*cleaned)


def cast_ints(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns as integers, all in one projection."""
    return df.withColumns({name: as_int(name) for name in columns})


def null_audit(df: DataFrame) -> DataFrame:
    """Per column, how many cells are NaN and how many are null or NaN: one pass."""
    counts = []
    for name in df.columns:
        nan = is_nan(df, name)
        counts.append(F.count_if(nan).alias(f"{name}_nan"))
        counts.append(F.count_if(F.col(name).isNull() | nan).alias(f"{name}_missing"))
    return df.agg(*counts)
