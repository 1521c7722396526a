"""Categorical buckets of the feature table, as tables of bounds.

Each bucket is a pure column expression, so it runs inside whole-stage codegen
and works the same on batch and streaming frames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Area code per area name.
AREA_CODES = {"NE": 1, "MNE": 2, "MNW": 3, "NW": 4, "SE": 5, "MSE": 6, "MSW": 7, "SW": 8}

# The mainland grid, scanned from the east. A station belongs to the
# first column of boxes whose western edge lies beyond it; latitude 37 divides the
# southern box from the northern one, which ends at latitude 50.
SOUTH_BELOW, NORTH_BELOW = 37, 50
GRID = [(80, "SE", "NE"), (95, "MSE", "MNE"), (110, "MSW", "MNW"), (125, "SW", "NW")]

# Schedule class by departure or arrival time (hhmm).
SCHEDULE_CODES = {"Busy": 1, "Least Busy": 2, "Most Busy": 3}
LEAST_BUSY_FROM, MOST_BUSY_FROM, MOST_BUSY_UNTIL = 600, 800, 1800

# Delay classes in minutes. Early classes exclude their upper bound,
# late classes include it.
DELAY_LABELS = {
    1: "60+min early",
    2: "30~60min early",
    3: "15~30min early",
    4: "5~15min early",
    5: "On Time",
    6: "5~15min late",
    7: "15~30min late",
    8: "30~60min late",
    9: "60+min late",
}
EARLY_BELOW = [(-60, 1), (-30, 2), (-15, 3), (-5, 4)]
LATE_UP_TO = [(5, 5), (15, 6), (30, 7), (60, 8)]
LATEST, ON_TIME = 9, 5

# Weather class codes, and the order in which one of them wins a day.
WEATHER_CODES = {"Rain": 1, "Snow": 2, "Wind": 3, "Sunny": 4}
WEATHER_PRIORITY = ["Snow", "Rain", "Wind", "Sunny"]
ELEMENTS_OF = {"Snow": ["SNWD", "SNOW"], "Rain": ["PRCP"], "Wind": ["WDF2", "WDF5"]}

# Elements that count as weather (found anywhere in the code).
WEATHER_PATTERN = "(PRCP|SNOW|SNWD|^WD+|^WS+)"
NO_WEATHER = "SUNNY"

# Carrier categories. Tables spell the first one both ways.
CARRIER_CODES = {"ULCC": 1, "LCC": 2, "Normal": 3}
CARRIER_SPELLINGS = {"ULLC": "ULCC"}


def first_match(rules: list[tuple[Column, object]]) -> Column:
    """A ``when`` chain; the caller adds ``otherwise``."""
    (condition, value), *rest = rules
    return reduce(lambda chain, rule: chain.when(rule[0], rule[1]), rest, F.when(condition, value))


def recode(column: Column, codes: dict) -> Column:
    """Map values through a small literal table; unknown values become null."""
    table = F.create_map(*[F.lit(item) for pair in codes.items() for item in pair])
    return F.try_element_at(table, column)


def area_name(lat: Column, lon: Column) -> Column:
    """Area of a point with west-positive longitude; null outside the grid."""
    rules = []
    for west, south, north in GRID:
        rules.append(((lat < SOUTH_BELOW) & (lon < west), F.lit(south)))
        rules.append(((lat < NORTH_BELOW) & (lon < west), F.lit(north)))
    east_edge, west_edge = GRID[0][0], GRID[-1][0]
    rules.append(((lat > NORTH_BELOW) & (lon > west_edge), F.lit("NW")))
    rules.append(((lat < SOUTH_BELOW) & (lon > west_edge), F.lit("SW")))
    rules.append(((lat > NORTH_BELOW) & (lon < east_edge), F.lit("NE")))
    return first_match(rules)


def area_label(lat: Column, lon: Column, station: Column) -> Column:
    """Area name, or the station id outside the grid."""
    return F.coalesce(area_name(lat, lon), station)


def area_code(lat: Column, lon: Column) -> Column:
    """Area code 1..8; null outside the grid."""
    return recode(area_name(lat, lon), AREA_CODES)


def schedule_code(hhmm: Column) -> Column:
    time = hhmm.try_cast("int")
    most = (time >= MOST_BUSY_FROM) & (time < MOST_BUSY_UNTIL)
    least = (time >= LEAST_BUSY_FROM) & (time < MOST_BUSY_FROM)
    return (
        F.when(most, SCHEDULE_CODES["Most Busy"])
        .when(least, SCHEDULE_CODES["Least Busy"])
        .otherwise(SCHEDULE_CODES["Busy"])
    )


def schedule_label(hhmm: Column) -> Column:
    return recode(schedule_code(hhmm), {code: name for name, code in SCHEDULE_CODES.items()})


def delay_code(minutes: Column) -> Column:
    """Delay class 1..9; an unknown delay counts as on time."""
    delay = minutes.try_cast("double")
    rules = [(delay < bound, F.lit(code)) for bound, code in EARLY_BELOW]
    rules += [(delay <= bound, F.lit(code)) for bound, code in LATE_UP_TO]
    rules.append((delay.isNotNull(), F.lit(LATEST)))
    return first_match(rules).otherwise(ON_TIME)


def delay_label(minutes: Column) -> Column:
    return recode(delay_code(minutes), DELAY_LABELS)


def carrier_code(category: Column) -> Column:
    """Code of a category that is given by name or already as a code."""
    spelled = F.coalesce(recode(category, CARRIER_SPELLINGS), category)
    codes = {str(code): code for code in CARRIER_CODES.values()}
    return recode(spelled, CARRIER_CODES | codes)


def carrier_label(category: Column) -> Column:
    """Name of a category that is given by name or as a code; other names stay."""
    return F.coalesce(recode(category, {str(code): name for name, code in CARRIER_CODES.items()}), category)


def is_weather(element: Column) -> Column:
    return element.rlike(WEATHER_PATTERN)


def weather_element(element: Column) -> Column:
    """The element code, or ``SUNNY`` for codes that are not weather."""
    return F.when(~is_weather(element), F.lit(NO_WEATHER)).otherwise(element)


def weather_rank(element: Column) -> Column:
    """Position of the element's class in the priority order: the day's class is the minimum."""
    sunny = WEATHER_PRIORITY.index("Sunny")
    rules = [
        (element.isin(elements), F.lit(WEATHER_PRIORITY.index(name)))
        for name, elements in ELEMENTS_OF.items()
    ]
    return first_match(rules).otherwise(sunny)


def weather_code(rank: Column) -> Column:
    return recode(rank, {i: WEATHER_CODES[name] for i, name in enumerate(WEATHER_PRIORITY)})


def weather_label(rank: Column) -> Column:
    return recode(rank, dict(enumerate(WEATHER_PRIORITY)))
