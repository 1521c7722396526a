"""Exploration queries over flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.functions.clean import as_double

# Delay causes and the names they are reported under.
CAUSES = {
    "WEATHER_DELAY": "Weather",
    "NAS_DELAY": "NAS",
    "SECURITY_DELAY": "Security",
    "LATE_AIRCRAFT_DELAY": "lateAircraft",
    "CARRIER_DELAY": "Carrier",
}


def delay_extremes(flights: DataFrame) -> DataFrame:
    """Largest and smallest departure and arrival delay."""
    return flights.agg(
        F.max(as_double("DEP_DELAY")).alias("dep_max"),
        F.min(as_double("DEP_DELAY")).alias("dep_min"),
        F.max(as_double("ARR_DELAY")).alias("arr_max"),
        F.min(as_double("ARR_DELAY")).alias("arr_min"),
    )


def airport_delay(flights: DataFrame) -> DataFrame:
    """Flights and mean departure delay per origin; unknown delays do not count."""
    return flights.groupBy("ORIGIN").agg(
        F.count("*").alias("conFlight"), F.avg(as_double("DEP_DELAY")).alias("delay")
    )


def top_delay_airports(flights: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` origins of highest mean delay."""
    return airport_delay(flights).orderBy(F.desc_nulls_last("delay"), "ORIGIN").limit(k)


def flights_from(flights: DataFrame, origin: str) -> DataFrame:
    """Flights of one origin; the value is a parameter, never part of the SQL text."""
    return flights.sparkSession.sql(
        "SELECT * FROM {flights} WHERE ORIGIN = :origin", args={"origin": origin}, flights=flights
    )


def carrier_month_delay(flights: DataFrame) -> DataFrame:
    """Mean of the positive departure delays per carrier and month."""
    return (
        flights.where(as_double("DEP_DELAY") > 0)
        .groupBy("OP_CARRIER", F.month("FL_DATE").alias("Month"))
        .agg(F.avg(as_double("DEP_DELAY")).alias("avgDelay"))
    )


def carrier_month_pivot(flights: DataFrame, carriers: list[str]) -> DataFrame:
    """One row per month, one column per named carrier.

    The months are those of any carrier. Naming the carriers spares the job that
    would list them.
    """
    return (
        carrier_month_delay(flights)
        .groupBy("Month")
        .pivot("OP_CARRIER", carriers)
        .agg(F.first("avgDelay"))
    )


def delay_causes(flights: DataFrame) -> DataFrame:
    """Total delay per cause."""
    return flights.agg(*[F.sum(as_double(name)).alias(alias) for name, alias in CAUSES.items()])


EXPLORED = {"airports": ["ORIGIN"], "carriers": ["OP_CARRIER", "Month"], "causes": []}


def explored(flights: DataFrame) -> DataFrame:
    """The three explorations from one scan: a row per origin, per carrier and month, and of all.

    ``part`` says which; columns that a part does not group by are null. Rows combine within a task
    before they are shuffled, so what is shuffled is the groups.
    """
    late = as_double("DEP_DELAY")
    dated = flights.withColumn("Month", F.month("FL_DATE"))
    keys = ["ORIGIN", "OP_CARRIER", "Month"]
    grouped = dated.groupingSets([[F.col(k) for k in sets] for sets in EXPLORED.values()], *[F.col(k) for k in keys])
    sums = [F.sum(as_double(name)).alias(alias) for name, alias in CAUSES.items()]
    measured = grouped.agg(
        F.grouping("ORIGIN").alias("_origin"),
        F.grouping("OP_CARRIER").alias("_carrier"),
        F.count("*").alias("conFlight"),
        F.avg(late).alias("delay"),
        F.avg(F.when(late > 0, late)).alias("avgDelay"),
        *sums,
    )
    part = F.when(F.col("_origin") == 0, "airports").when(F.col("_carrier") == 0, "carriers").otherwise("causes")
    return measured.withColumn("part", part).drop("_origin", "_carrier")


def explored_part(found: DataFrame, part: str) -> DataFrame:
    """One part of :func:`explored`, as the exploration of that name gives it."""
    rows = found.where(F.col("part") == part)
    if part == "airports":
        return rows.select("ORIGIN", "conFlight", "delay")
    if part == "carriers":
        return rows.where(F.col("avgDelay").isNotNull()).select("OP_CARRIER", "Month", "avgDelay")
    return rows.select(*CAUSES.values())


def carriers_of(flights: DataFrame) -> DataFrame:
    return flights.select("OP_CARRIER").distinct()


def without_outliers(flights: DataFrame, minutes: float = 150) -> DataFrame:
    """Flights delayed at most ``minutes``; unknown delays drop out."""
    return flights.where(as_double("DEP_DELAY") <= minutes)


def month_and_day(flights: DataFrame) -> DataFrame:
    """Flight date parsed from text, as month and day of month."""
    parsed = F.to_date(F.col("FL_DATE").cast("string"), "yyyy-MM-dd")
    return flights.withColumns({"MONTH": F.month(parsed), "DAY": F.dayofmonth(parsed)})
