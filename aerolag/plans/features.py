"""The feature job: flights x stations x daily weather, in categories.

Order of work, chosen for one wide shuffle of the flights:

1. both area lookups and the drop of flights without stations (map side);
2. the weather of both ends, from one row per station and month, and the drop of flights that
   meet none (map side);
3. removal of flights equal on every key column. Equal rows combine before the
   shuffle, so a group of copies never travels whole;
4. bucketing.

Weather is unique per station and day, so it adds no rows, and steps 2 and 3 may change places.
They do when a lookup table is too large for the map side: copies then go first, and what is left
is stored, so that finding its hot keys does not compute it again. If the airports are too large,
steps 1 and 2 are one lookup per end, by airport and month, and equal flights go once more after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.functions import buckets
from aerolag.operators import places
from aerolag.operators.joins import BROADCAST_ROWS, LOOKUP_BYTES, LOOKUP_ROWS, fits_broadcast, is_small, measure
from aerolag.operators.weather import (
    daily_elements,
    daily_weather,
    monthly_at_airports,
    monthly_weather,
    with_airport_weather,
    with_monthly_weather,
    with_weather_lists,
)
from aerolag.schemas import ATTRIBUTES, LABEL
from aerolag.session import checkpointed, stored

RAW_KEYS = [
    "FL_DATE",
    "OP_CARRIER",
    "OP_CARRIER_FL_NUM",
    "CRS_DEP_TIME",
    "DEP_DELAY",
    "CRS_ARR_TIME",
    "ARR_DELAY",
]
STATUS_KEYS = ["DIVERTED", "CANCELLED"]
RANK_KEYS = ["ORIG_WEATHER_RANK", "DEST_WEATHER_RANK"]
END_KEYS = ["ORIG_STATION", "ORIG_AREA", "DEST_STATION", "DEST_AREA"]


def located_flights(
    flights: DataFrame, areas: DataFrame, small: bool, keep_status: bool = False
) -> DataFrame:
    """Distinct flights with a station at both ends."""
    raw_keys = RAW_KEYS + (STATUS_KEYS if keep_status else [])
    flown = flights.select(*raw_keys, "ORIGIN", "DEST")
    if small:
        return _at_stations(flown, areas).distinct()
    # The lookups will shuffle: copies combine before they do, and hot keys are counted in what is
    # stored, so that no lookup is computed again to find them.
    flown = stored(flown.distinct())
    located = places.with_areas(flown, areas, "inner", small, flown)
    return stored(located.select(*raw_keys, *END_KEYS).distinct())


def _at_stations(flown: DataFrame, areas: DataFrame) -> DataFrame:
    """Flights with a station at both ends, equal ones included, from areas that are broadcast."""
    raw_keys = [name for name in flown.columns if name not in ("ORIGIN", "DEST")]
    return places.with_areas(flown, areas, "inner", True).select(*raw_keys, *END_KEYS)


def met_flights(
    flights: DataFrame,
    areas: DataFrame,
    monthly: DataFrame,
    small_areas: bool,
    small_weather: bool,
    keep_status: bool = False,
) -> DataFrame:
    """Distinct flights with a station at both ends that meet weather, with its ranks."""
    raw_keys = RAW_KEYS + (STATUS_KEYS if keep_status else [])
    flown = flights.select(*raw_keys, "ORIGIN", "DEST")
    if small_areas and small_weather:
        return with_monthly_weather(_at_stations(flown, areas), monthly, True).distinct()
    if small_areas:
        located = stored(located_flights(flights, areas, True, keep_status))
        return with_monthly_weather(located, monthly, False, located)
    # Every lookup shuffles the flights, so station, area and weather of an end come from one. Copies
    # combine before, and hot keys of both are counted in what is stored.
    flown = stored(flown.distinct())
    served = stored(monthly_at_airports(areas, monthly))
    met = with_airport_weather(flown, served, False, flown)
    return met.select(*raw_keys, *END_KEYS, *RANK_KEYS).distinct()


def feature_table(
    flights: DataFrame,
    bridge: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    carriers: DataFrame,
    labels: bool = False,
    with_year: bool = False,
    max_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """The nine categorical columns per flight, as codes or as labels.

    Area columns are text either way, since a station outside the grid stands for
    itself. ``with_year`` appends ``YEAR`` to write all years partitioned in one job.
    """
    areas = places.areas(places.station_geo(bridge, stations))
    # Written once: it is measured, and joined at both ends.
    monthly = checkpointed(monthly_weather(daily_weather(weather)))
    small_areas, small_weather, small_carriers = fits_broadcast(
        areas, monthly, carriers, max_rows=max_rows, max_bytes=LOOKUP_BYTES
    )
    areas = areas if labels else with_area_codes(areas)
    met = met_flights(flights, areas, monthly, small_areas, small_weather)
    if not small_carriers:
        met = stored(met)
    return finished(in_categories(met, carriers, small_carriers, labels), labels, with_year)


def with_area_codes(areas: DataFrame) -> DataFrame:
    """Areas named by their code; a station outside the grid stands for itself."""
    return areas.withColumn("AREA", F.coalesce(F.col("AREA_CODE").cast("string"), F.col("STATION")))


def in_categories(
    distinct: DataFrame, carriers: DataFrame, small_carriers: bool | None = None, labels: bool = False
) -> DataFrame:
    """Located flights with carrier, delays and schedules as categories; ranks of weather stay."""
    delay, schedule, carrier = (
        (buckets.delay_label, buckets.schedule_label, buckets.carrier_label)
        if labels
        else (buckets.delay_code, buckets.schedule_code, buckets.carrier_code)
    )
    return places.with_carrier_type(distinct, carriers, small_carriers).select(
        "FL_DATE",
        *END_KEYS,
        *[name for name in distinct.columns if name in RANK_KEYS],
        carrier(F.col("CARRIER_TYPE")).alias("CARRIER_TYPE"),
        delay(F.col("DEP_DELAY")).alias("DEP_DELAY_CAT"),
        delay(F.col("ARR_DELAY")).alias(LABEL),
        schedule(F.col("CRS_DEP_TIME")).alias("ORIG_SCHEDULE"),
        schedule(F.col("CRS_ARR_TIME")).alias("DEST_SCHEDULE"),
    )


def finished(met: DataFrame, labels: bool = False, with_year: bool = False) -> DataFrame:
    """The feature columns of flights that have met weather."""
    weather_class = buckets.weather_label if labels else buckets.weather_code
    met = met.withColumns(
        {
            f"{end}_WEATHER": weather_class(F.col(f"{end}_WEATHER_RANK"))
            for end in ("ORIG", "DEST")
        }
    )
    year = [F.year("FL_DATE").alias("YEAR")] if with_year else []
    return met.select(*ATTRIBUTES, LABEL, *year)


def network_table(
    flights: DataFrame,
    bridge: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    keep_status: bool = False,
    max_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """Input of the neural net: raw delays and times with area and weather labels."""
    areas = places.areas(places.station_geo(bridge, stations))
    # Written once: it is measured, and joined at both ends.
    monthly = checkpointed(monthly_weather(daily_weather(weather)))
    small_areas, small_weather = fits_broadcast(
        areas, monthly, max_rows=max_rows, max_bytes=LOOKUP_BYTES
    )
    met = met_flights(flights, areas, monthly, small_areas, small_weather, keep_status)
    return met.select(
        *RAW_KEYS,
        *(STATUS_KEYS if keep_status else []),
        "ORIG_AREA",
        "DEST_AREA",
        buckets.weather_label(F.col("ORIG_WEATHER_RANK")).alias("ORIG_WEATHER"),
        buckets.weather_label(F.col("DEST_WEATHER_RANK")).alias("DEST_WEATHER"),
    )


def weather_lists(
    flights: DataFrame,
    bridge: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    max_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """Distinct flights with how often each element code is met at either end.

    Equal flights, and a station that serves several airports, count as often as they occur. A row of
    daily weather holds lists, so it is broadcast up to ``BROADCAST_ROWS`` only.
    """
    areas = places.areas(places.station_geo(bridge, stations))
    daily = stored(daily_elements(weather))
    of_areas, of_daily = measure(areas, daily)
    small_areas = is_small(of_areas, max_rows, LOOKUP_BYTES)
    small_daily = is_small(of_daily, min(max_rows, BROADCAST_ROWS))
    if small_areas:
        # Located on the map side, so that copies are counted in one shuffle.
        located = _at_stations(flights.select(*RAW_KEYS, "ORIGIN", "DEST"), areas)
        located = located.groupBy(*RAW_KEYS, *END_KEYS).agg(F.count("*").alias("copies"))
    else:
        flown = stored(flights.groupBy(*RAW_KEYS, "ORIGIN", "DEST").agg(F.count("*").alias("copies")))
        located = places.with_areas(flown, areas, "inner", False, flown)
        located = located.groupBy(*RAW_KEYS, *END_KEYS).agg(F.sum("copies").alias("copies"))
    if not small_daily:
        located = stored(located)
    met = with_weather_lists(located, daily, small_daily, located)
    counted = {
        f"{end}_WEATHERS": F.transform_values(f"{end}_WEATHERS", lambda _, n: n * F.col("copies"))
        for end in ("ORIG", "DEST")
    }
    return met.withColumns(counted).drop("copies")


def training_rows(features: DataFrame) -> DataFrame:
    """Encoded features as nine integers; 0 stands for an unknown carrier type or area."""
    return features.select(
        *[F.coalesce(F.col(name).try_cast("int"), F.lit(0)).alias(name) for name in [*ATTRIBUTES, LABEL]]
    )
