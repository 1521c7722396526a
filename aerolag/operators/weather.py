"""Weather at both ends of a flight, without pairing observations.

The rule is defined over pairs (origin observation, destination observation) of
one flight day: a pair counts when either side qualifies, that is, shows a
non-zero value of a weather element. So

* a flight is kept when either end has a qualifying observation and both ends
  have observations at all;
* an end contributes all its observations when the *other* end qualifies, and
  only its qualifying ones otherwise.

It follows that one row per station and day is enough: the day's class over all
observations and its class over the qualifying ones. Both are small numbers, so the days
of a station and month fit into one row, and a lookup table of those stays small for long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.functions import buckets
from aerolag.operators.joins import fits_broadcast, lookup_join

STATION_DAY = ["STATION", "DAY"]
# Both ranks of a day are one number: the rank over all times RANKS plus the qualifying one, or
# UNRANKED in place of either that is missing. A row of a month has a place for each of MONTH_DAYS.
RANKS = 8
UNRANKED = RANKS - 1
MONTH_DAYS = 31
ENDS = {"ORIG": "DEST", "DEST": "ORIG"}


def qualifies() -> Column:
    """A non-zero value of a weather element; unknown values do not qualify."""
    weather = (F.col("DATA_VALUE").try_cast("double") != 0) & buckets.is_weather(F.col("ELEMENT"))
    return F.coalesce(weather, F.lit(False))


def daily_weather(weather: DataFrame) -> DataFrame:
    """One row per station and day: class rank over all and over qualifying observations."""
    rank = buckets.weather_rank(F.col("ELEMENT"))
    return weather.groupBy(
        F.col("STATION_ID").alias("STATION"), F.col("OBS_DATE").alias("DAY")
    ).agg(
        F.min(rank).alias("ALL_RANK"),
        F.min(F.when(qualifies(), rank)).alias("QUALIFYING_RANK"),
    )


def monthly_weather(daily: DataFrame) -> DataFrame:
    """:func:`daily_weather` by station and month: ``CODES`` has a number per day, null without observations."""
    ranks = {name: F.coalesce(F.col(name), F.lit(UNRANKED)) for name in ("ALL_RANK", "QUALIFYING_RANK")}
    code = (ranks["ALL_RANK"] * RANKS + ranks["QUALIFYING_RANK"]).cast("tinyint")
    day = F.struct(F.dayofmonth("DAY").alias("day"), code.alias("code"))
    # Station-days are unique, so a group has at most as many rows as a month has days.
    months = (
        daily.where(F.col("STATION").isNotNull() & F.col("DAY").isNotNull())
        .groupBy("STATION", F.trunc("DAY", "month").alias("MONTH"))
        .agg(F.map_from_entries(F.collect_list(day)).alias("days"))
    )
    days = F.sequence(F.lit(1), F.lit(MONTH_DAYS))
    return months.select("STATION", "MONTH", F.transform(days, lambda d: F.try_element_at("days", d)).alias("CODES"))


def daily_elements(weather: DataFrame) -> DataFrame:
    """The same row with observations per known element, and qualifying ones among them.

    ``SEEN`` and ``QUALIFIED`` count all observations of the day, those without an element included.
    """
    by_element = weather.groupBy(
        F.col("STATION_ID").alias("STATION"),
        F.col("OBS_DATE").alias("DAY"),
        buckets.weather_element(F.col("ELEMENT")).alias("element"),
    ).agg(F.count("*").alias("n"), F.count_if(qualifies()).alias("q"))
    known = F.when(F.col("element").isNotNull(), F.struct("element", "n", "q"))
    return by_element.groupBy(*STATION_DAY).agg(
        F.sort_array(F.collect_list(known)).alias("ELEMENTS"),
        F.sum("n").alias("SEEN"),
        F.sum("q").alias("QUALIFIED"),
    )


def join_both_ends(
    flights: DataFrame,
    daily: DataFrame,
    small: bool | None = None,
    key_source: DataFrame | None = None,
    laid_out: bool = False,
) -> DataFrame:
    """Flights with the daily row of either end, its columns prefixed ``ORIG_`` and ``DEST_``.

    ``laid_out`` says that ``daily`` lies in buckets of its keys, sorted: it is merged where it lies.
    """
    values = [name for name in daily.columns if name not in STATION_DAY]
    if small is None and not laid_out:
        [small] = fits_broadcast(daily)
    for end in ENDS:
        at_end = daily.select(
            F.col("STATION").alias(f"{end}_STATION"),
            F.col("DAY").alias("FL_DATE"),
            *[F.col(name).alias(f"{end}_{name}") for name in values],
        )
        keys = [f"{end}_STATION", "FL_DATE"]
        if laid_out:
            flights = flights.join(at_end.hint("merge"), keys, "inner")
            continue
        source = None if key_source is None else key_source.select(*keys)
        flights = lookup_join(flights, at_end, keys, "inner", small, source)
    return flights


def with_weather(
    flights: DataFrame,
    daily: DataFrame,
    small: bool | None = None,
    key_source: DataFrame | None = None,
    laid_out: bool = False,
) -> DataFrame:
    """Flights that meet weather, from :func:`daily_weather` rows, with ``ORIG_WEATHER_RANK`` and ``DEST_WEATHER_RANK``."""
    return _ranked(join_both_ends(flights, daily, small, key_source, laid_out))


def with_monthly_weather(
    flights: DataFrame, monthly: DataFrame, small: bool, key_source: DataFrame | None = None
) -> DataFrame:
    """The same flights, from :func:`monthly_weather` rows."""
    both = _in_month(flights)
    for end in ENDS:
        at_end = monthly.select(
            F.col("STATION").alias(f"{end}_STATION"), F.col("MONTH").alias("_month"), F.col("CODES").alias("_codes")
        )
        keys = [f"{end}_STATION", "_month"]
        source = None if key_source is None else _in_month(key_source).select(*keys)
        both = _on_day(lookup_join(both, at_end, keys, "inner", small, source), end)
    return _decoded(both)


def monthly_at_airports(areas: DataFrame, monthly: DataFrame) -> DataFrame:
    """:func:`monthly_weather` of the stations of every airport, with their areas."""
    served = areas.where(F.col("AIRPORT_CODE").isNotNull() & F.col("STATION").isNotNull())
    return served.select("AIRPORT_CODE", "STATION", "AREA").distinct().join(monthly, "STATION")


def with_airport_weather(
    flights: DataFrame, served: DataFrame, small: bool | None = None, key_source: DataFrame | None = None
) -> DataFrame:
    """The same flights from their airports, with station and area: one lookup of :func:`monthly_at_airports` per end."""
    both = _in_month(flights)
    for airport, end in (("ORIGIN", "ORIG"), ("DEST", "DEST")):
        at_end = served.select(
            F.col("AIRPORT_CODE").alias(airport),
            F.col("MONTH").alias("_month"),
            F.col("STATION").alias(f"{end}_STATION"),
            F.col("AREA").alias(f"{end}_AREA"),
            F.col("CODES").alias("_codes"),
        )
        keys = [airport, "_month"]
        source = None if key_source is None else _in_month(key_source).select(*keys)
        both = _on_day(lookup_join(both, at_end, keys, "inner", small, source), end).drop(airport)
    return _decoded(both)


def _in_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_month", F.trunc("FL_DATE", "month"))


def _on_day(met: DataFrame, end: str) -> DataFrame:
    """The code of the flight's day out of its month's, in ``_ORIG`` or ``_DEST``; flights without one are dropped."""
    code = F.get("_codes", F.dayofmonth("FL_DATE") - 1)
    return met.withColumn(f"_{end}", code).where(F.col(f"_{end}").isNotNull()).drop("_codes")


def _decoded(both: DataFrame) -> DataFrame:
    """Flights that meet weather, their codes taken apart."""

    def rank(number: Column) -> Column:
        return F.when(number != UNRANKED, number.cast("int"))

    ranks = {}
    for end in ENDS:
        code = F.col(f"_{end}").cast("int")
        ranks[f"{end}_ALL_RANK"] = rank(F.floor(code / RANKS))
        ranks[f"{end}_QUALIFYING_RANK"] = rank(code % RANKS)
    return _ranked(both.withColumns(ranks).drop("_month", *[f"_{end}" for end in ENDS]))


def _ranked(both: DataFrame) -> DataFrame:
    """Flights with the ranks of both ends, less those that meet no weather, with one rank per end."""
    qualifying = {end: F.col(f"{end}_QUALIFYING_RANK") for end in ENDS}
    # An end whose own rank is missing here was unqualified on both sides and is dropped.
    ranks = {
        f"{end}_WEATHER_RANK": F.when(
            qualifying[other].isNotNull(), F.col(f"{end}_ALL_RANK")
        ).otherwise(qualifying[end])
        for end, other in ENDS.items()
    }
    kept = both.where(qualifying["ORIG"].isNotNull() | qualifying["DEST"].isNotNull())
    return kept.withColumns(ranks).drop(
        *[f"{end}_{name}" for end in ENDS for name in ("ALL_RANK", "QUALIFYING_RANK")]
    )


def with_weather_lists(
    flights: DataFrame,
    daily: DataFrame,
    small: bool | None = None,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """The same flights, from :func:`daily_elements` rows, with ``ORIG_WEATHERS`` and ``DEST_WEATHERS``.

    Each maps an element code to how often it occurs in the list over all pairs: a qualifying
    observation pairs with every one of the other end, another only with qualifying ones.
    """
    both = join_both_ends(flights, daily, small, key_source)

    def occurrences(end: str, other: str) -> Column:
        times = F.transform(
            f"{end}_ELEMENTS",
            lambda e: F.struct(
                e["element"].alias("element"),
                (
                    e["q"] * F.col(f"{other}_SEEN") + (e["n"] - e["q"]) * F.col(f"{other}_QUALIFIED")
                ).alias("times"),
            ),
        )
        return F.map_from_entries(F.filter(times, lambda e: e["times"] > 0))

    kept = both.where((F.col("ORIG_QUALIFIED") > 0) | (F.col("DEST_QUALIFIED") > 0))
    return kept.withColumns(
        {f"{end}_WEATHERS": occurrences(end, other) for end, other in ENDS.items()}
    ).drop(*[f"{end}_{name}" for end in ENDS for name in ("ELEMENTS", "SEEN", "QUALIFIED")])
