"""Flights and daily weather laid out for their joins: in buckets of station and day, sorted.

Written once, every later job merges the two where they lie: the origin join moves nothing, the
destination join moves the flights only. Buckets follow the keys as they are, so a key that holds
more than a few buckets' worth of flights is refused; such flights take the salted lookup of
:func:`aerolag.plans.features.feature_table`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.operators import places
from aerolag.operators.joins import fits_broadcast, hot_keys
from aerolag.operators.weather import ENDS, daily_weather, with_weather
from aerolag.plans.features import finished, in_categories, located_flights, with_area_codes
from aerolag.session import checkpointed

# A key is refused that holds more than this many buckets' worth of rows.
HOT_BUCKETS = 4
KEYS = {"flights": ["ORIG_STATION", "FL_DATE"], "daily": ["STATION", "DAY"]}


def _write(df: DataFrame, name: str, table: str, path: str, buckets: int) -> None:
    keys = KEYS[table]
    # One task per bucket, so that a bucket is one file and keeps its order when it is read.
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").option("path", f"{path}/{table}").format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"{name}_{table}")


def lay_out(
    flights: DataFrame,
    bridge: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    carriers: DataFrame,
    name: str,
    path: str,
    buckets: int | None = None,
) -> None:
    """Write the located flights in categories as ``<name>_flights``, station-days as ``<name>_daily``."""
    spark = flights.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    areas = with_area_codes(places.areas(places.station_geo(bridge, stations)))
    small_areas, small_carriers = fits_broadcast(areas, carriers)
    located = checkpointed(located_flights(flights, areas, small_areas))
    for end in ENDS:
        # So few buckets are no finer than one key may be.
        if buckets <= HOT_BUCKETS:
            break
        if not hot_keys(located, [f"{end}_STATION", "FL_DATE"], buckets // HOT_BUCKETS).isEmpty():
            raise ValueError(f"a station and day of {end} holds too many flights for {buckets} buckets")
    _write(in_categories(located, carriers, small_carriers), name, "flights", path, buckets)
    _write(daily_weather(weather), name, "daily", path, buckets)


def open_layout(spark: SparkSession, name: str, path: str, buckets: int) -> None:
    """Name a layout that another session has written, in this session's catalog."""
    for table, keys in KEYS.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/{table}").schema)
        listed = ", ".join(keys)
        spark.sql(f"DROP TABLE IF EXISTS {name}_{table}")
        spark.sql(
            f"CREATE TABLE {name}_{table} ({columns}) USING parquet CLUSTERED BY ({listed}) SORTED BY ({listed})"
            f" INTO {buckets} BUCKETS LOCATION '{path}/{table}'"
        )


def features(spark: SparkSession, name: str, with_year: bool = False) -> DataFrame:
    """The feature table as codes, from a layout."""
    met = with_weather(spark.table(f"{name}_flights"), spark.table(f"{name}_daily"), laid_out=True)
    return finished(met, with_year=with_year)
