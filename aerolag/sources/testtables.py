"""The job's input tables, derived from the shared test tables.

Each function reads whole Parquet tables and renames or computes columns, so the
result grows with them. The columns are those the CSV readers declare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that no job has to read footers for the schema.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _code(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def flights(spark: SparkSession, folder: str, calendar: bool = False) -> DataFrame:
    """Flights on the 30 days that have weather, or with ``calendar`` on the days of their orders."""
    events = table(spark, folder, "events")
    places = events.agg(F.max("user_id") + 1).scalar()
    ordered = F.col("o_orderdate")
    day_number = F.year(ordered) * 372 + F.month(ordered) * 31 + F.day(ordered)
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    quantity = F.col("l_quantity")
    known = order % 50 != 0
    departure = (quantity - 25) * 3
    elapsed = (part % 120 + 60).cast("double")
    return (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            (
                ordered.cast("date")
                if calendar
                else F.date_add(F.lit("2024-01-01").cast("date"), day_number % 30)
            ).alias("FL_DATE"),
            F.col("p_brand").alias("OP_CARRIER"),
            (order % 7000).cast("int").alias("OP_CARRIER_FL_NUM"),
            _code("A", supplier * 13 % places).alias("ORIGIN"),
            _code("A", F.col("o_custkey") % places).alias("DEST"),
            ((order * 37 + line * 101) % 24 * 100 + part % 60).cast("int").alias("CRS_DEP_TIME"),
            F.when(known, departure).alias("DEP_DELAY"),
            ((order * 53 + line * 11) % 24 * 100 + supplier % 60).cast("int").alias("CRS_ARR_TIME"),
            ((order * 53 + line * 11) % 24 * 100 + part % 60).cast("int").alias("ARR_TIME"),
            F.when(known, departure + part % 21 - 10).alias("ARR_DELAY"),
            (F.col("l_returnflag") == "R").cast("int").alias("CANCELLED"),
            (F.col("l_linestatus") == "F").cast("int").alias("DIVERTED"),
            elapsed.alias("ACTUAL_ELAPSED_TIME"),
            (elapsed - 20).alias("AIR_TIME"),
            (line + 3).cast("double").alias("TAXI_IN"),
            (supplier % 17 + 5).cast("double").alias("TAXI_OUT"),
            F.col("l_extendedprice").alias("DISTANCE"),
            F.round(F.col("l_tax") * 100).alias("WEATHER_DELAY"),
            F.round(F.col("l_discount") * 100).alias("NAS_DELAY"),
            line.cast("double").alias("SECURITY_DELAY"),
            F.when(quantity > 25, quantity - 25).alias("LATE_AIRCRAFT_DELAY"),
            F.when(quantity > 40, quantity).alias("CARRIER_DELAY"),
        )
    )


def flights_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Flights as a CSV reader would hand them over: text, with missing markers."""
    carrier = (
        F.when(F.col("CRS_DEP_TIME") % 97 == 0, "None")
        .when(F.col("CRS_DEP_TIME") % 89 == 0, "")
        .otherwise(F.col("OP_CARRIER"))
    )
    # Three times as long, so that some are beyond the bound for outliers.
    delay = F.col("DEP_DELAY") * 3
    written = delay.cast("decimal(9,1)").cast("string")
    return flights(spark, folder).select(
        "ORIGIN",
        "DEST",
        carrier.alias("OP_CARRIER"),
        F.when(delay.isNull(), "NULL").when(delay != 0, written).alias("DEP_DELAY"),
        F.when(F.col("ARR_DELAY") % 7 == 0, "NaN")
        .otherwise(F.col("ARR_DELAY").cast("decimal(9,1)").cast("string"))
        .alias("ARR_DELAY"),
        F.col("CRS_DEP_TIME").cast("string").alias("CRS_DEP_TIME"),
        F.col("DISTANCE").cast("decimal(12,2)").cast("string").alias("DISTANCE"),
    )


def airports_stations(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    served = table(spark, folder, "events").where(user % 20 != 0)
    return served.select(
        _code("A", user).alias("ORIGIN"), _code("S", user).alias("STATION")
    ).distinct()


def stations(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    return (
        table(spark, folder, "events")
        .select(
            _code("S", user).alias("STATION"),
            (user * 7 % 37 + 18).cast("double").alias("LAT"),
            (-(user * 11 % 75 + 60)).cast("double").alias("LON"),
        )
        .distinct()
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    element = (
        F.when(kind == "click", "PRCP")
        .when(kind == "view", "SNOW")
        .when(kind == "purchase", "WDF2")
        .when(kind == "signup", "TMAX")
        .otherwise("WT18")
    )
    return table(spark, folder, "events").select(
        _code("S", F.col("user_id")).alias("STATION_ID"),
        F.col("ts").cast("date").alias("OBS_DATE"),
        element.alias("ELEMENT"),
        F.floor(F.col("value") / 20).cast("double").alias("DATA_VALUE"),
    )


def carriers(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.col("p_brand")
    category = (
        F.when(F.length(brand) == 7, "ULCC")
        .when(brand < "Brand#14", "LCC")
        .when(brand < "Brand#18", "2")
        .when(brand < "Brand#22", "3")
        .otherwise("Normal")
    )
    return (
        table(spark, folder, "part")
        .where(brand != "Brand#9")
        .select(brand.alias("OP_CARRIER"), category.alias("CATEGORY"))
        .distinct()
    )


def airports(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    code = _code("A", user)
    return (
        table(spark, folder, "events")
        .where(user % 11 != 0)
        .select(
            user.alias("ident"),
            F.when(user % 3 != 2, code).alias("local_code"),
            F.when(user % 3 == 1, _code("X", user)).otherwise(code).alias("iata_code"),
            _code("name ", user).alias("name"),
            _code("US-", user % 7).alias("local_region"),
            _code("city ", user % 13).alias("municipality"),
        )
        .distinct()
    )
