"""Airports, stations, areas and carriers: the dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.functions import buckets
from aerolag.operators.joins import fits_broadcast, lookup_join


def airport_codes(flights: DataFrame) -> DataFrame:
    """Every code flown from or to: one scan, one distinct."""
    return flights.select(F.explode(F.array("ORIGIN", "DEST")).alias("ORIGIN")).distinct()


def airport_directory(codes: DataFrame, airports: DataFrame) -> DataFrame:
    """Codes with the airport known under them locally or by IATA; unknown codes keep nulls.

    The two code columns become one key column, so the join is an equi-join. An
    airport whose two codes agree appears once under that key.
    """
    names = F.array_compact(F.array_distinct(F.array("local_code", "iata_code")))
    keyed = airports.select(
        F.explode(names).alias("ORIGIN"),
        F.col("local_region").alias("STATE"),
        F.col("municipality").alias("CITY"),
        F.col("local_code").alias("LOCAL"),
        F.col("iata_code").alias("IATA"),
        F.col("ident").alias("IDENT"),
        F.col("name").alias("NAME"),
    )
    return codes.join(keyed, "ORIGIN", "left")


def station_geo(bridge: DataFrame, stations: DataFrame) -> DataFrame:
    """Airports with the coordinates of their stations, longitude counted to the west."""
    places = stations.select(
        "STATION",
        F.col("LAT").try_cast("double").alias("LATITUDE"),
        (-F.col("LON").try_cast("double")).alias("LONGITUDE"),
    )
    return bridge.join(places, "STATION", "left").withColumnRenamed("ORIGIN", "AIRPORT_CODE")


def geo_extremes(geo: DataFrame) -> DataFrame:
    return geo.agg(
        F.max("LATITUDE").alias("lat_max"),
        F.min("LATITUDE").alias("lat_min"),
        F.max("LONGITUDE").alias("lon_max"),
        F.min("LONGITUDE").alias("lon_min"),
    )


def areas(geo: DataFrame) -> DataFrame:
    """Airport, station, area label (or station id) and area code (or null)."""
    lat, lon = F.col("LATITUDE"), F.col("LONGITUDE")
    return geo.select(
        "AIRPORT_CODE",
        "STATION",
        buckets.area_label(lat, lon, F.col("STATION")).alias("AREA"),
        buckets.area_code(lat, lon).alias("AREA_CODE"),
    )


def with_areas(
    flights: DataFrame,
    areas: DataFrame,
    how: str = "left",
    small: bool | None = None,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Flights with station and area of both ends.

    ``key_source`` may name a stored frame with the airport columns to find hot airports in; without
    it they are looked for in ``flights`` before either join.

    The same dimension plays both roles. A flight appears once per station of its
    airports. ``how="inner"`` leaves out flights from or to places without a station.
    """
    if how == "inner":
        areas = areas.where(F.col("STATION").isNotNull())
    if small is None:
        [small] = fits_broadcast(areas)
    source = flights if key_source is None else key_source
    for airport, end in (("ORIGIN", "ORIG"), ("DEST", "DEST")):
        at_end = areas.select(
            F.col("AIRPORT_CODE").alias(airport),
            F.col("STATION").alias(f"{end}_STATION"),
            F.col("AREA").alias(f"{end}_AREA"),
            F.col("AREA_CODE").alias(f"{end}_AREA_CODE"),
        )
        flights = lookup_join(flights, at_end, [airport], how, small, source.select(airport))
    return flights


def with_carrier_type(
    flights: DataFrame, carriers: DataFrame, small: bool | None = None
) -> DataFrame:
    """Flights with ``CARRIER_TYPE``; an unknown carrier gets null."""
    types = carriers.select("OP_CARRIER", F.col("CATEGORY").alias("CARRIER_TYPE"))
    return lookup_join(flights, types, ["OP_CARRIER"], "left", small)


def weather_at_airports(
    weather: DataFrame, bridge: DataFrame, small: bool | None = None
) -> DataFrame:
    """Observations of stations that serve an airport, one row per airport served."""
    served = bridge.where(F.col("ORIGIN").isNotNull()).select(
        F.col("STATION").alias("STATION_ID"), F.col("ORIGIN").alias("AIRPORT_CODE")
    )
    return lookup_join(weather, served, ["STATION_ID"], "inner", small)
