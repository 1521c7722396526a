"""Weather classes against the rule over pairs of observations."""

import datetime
import random
from collections import Counter, defaultdict

import pytest

from aerolag.operators import weather
from aerolag.functions import buckets
from pyspark.sql import functions as F

DAY = datetime.date(2018, 1, 2)
ELEMENTS = ["PRCP", "SNOW", "SNWD", "WDF2", "WDF5", "WSF2", "WT18", "TMAX", None]
FLIGHTS = "id int, ORIG_STATION string, DEST_STATION string, FL_DATE date"
OBSERVATIONS = "STATION_ID string, OBS_DATE date, ELEMENT string, DATA_VALUE double"


def classes(spark, observations, flights, small=True):
    obs = spark.createDataFrame(observations, OBSERVATIONS)
    met = weather.with_weather(
        spark.createDataFrame(flights, FLIGHTS), weather.daily_weather(obs), small
    )
    rows = met.select(
        "id",
        buckets.weather_label(F.col("ORIG_WEATHER_RANK")),
        buckets.weather_label(F.col("DEST_WEATHER_RANK")),
    ).collect()
    return {row[0]: (row[1], row[2]) for row in rows}


def monthly_classes(spark, observations, flights, small=True):
    obs = spark.createDataFrame(observations, OBSERVATIONS)
    rows = spark.createDataFrame(flights, FLIGHTS)
    met = weather.with_monthly_weather(rows, weather.monthly_weather(weather.daily_weather(obs)), small)
    ranks = [buckets.weather_label(F.col(f"{end}_WEATHER_RANK")) for end in ("ORIG", "DEST")]
    return {row[0]: (row[1], row[2]) for row in met.select("id", *ranks).collect()}


def lists(spark, observations, flights):
    obs = spark.createDataFrame(observations, OBSERVATIONS)
    met = weather.with_weather_lists(
        spark.createDataFrame(flights, FLIGHTS), weather.daily_elements(obs), True
    )
    return {row["id"]: (row["ORIG_WEATHERS"], row["DEST_WEATHERS"]) for row in met.collect()}


CASES = [
    ([("TMAX", 5)], [("TMAX", 5)], None),
    ([("TMAX", 5)], [("SNOW", 5)], ("Sunny", "Snow")),
    ([("PRCP", 0)], [("SNOW", 5)], ("Rain", "Snow")),
    ([("PRCP", 0), ("WDF2", 20)], [("TMAX", 5)], ("Wind", "Sunny")),
    ([("WT18", 1)], [("PRCP", 3)], ("Sunny", "Rain")),
    ([], [("SNOW", 5)], None),
    ([(None, 5)], [("SNOW", 5)], ("Sunny", "Snow")),
    ([("PRCP", None)], [("TMAX", 5)], None),
]


@pytest.mark.parametrize("small", [True, False])
def test_fixture_cases(spark, small):
    observations, flights, expected = [], [], {}
    for i, (origin, dest, result) in enumerate(CASES):
        flights.append((i, f"o{i}", f"d{i}", DAY))
        for station, seen in ((f"o{i}", origin), (f"d{i}", dest)):
            observations += [(station, DAY, e, None if v is None else float(v)) for e, v in seen]
        if result:
            expected[i] = result
    assert classes(spark, observations, flights, small) == expected
    undated = [(None, DAY, "SNOW", 5.0), ("o1", None, "SNOW", 5.0)]
    nowhere = [(-1, None, "d1", DAY), (-2, "o1", "d1", None), (-3, "o1", "d1", datetime.date(2018, 2, 2))]
    assert monthly_classes(spark, observations + undated, flights + nowhere, small) == expected


def by_pairs(observations, flights):
    """The rule itself: every pair of observations of a flight, then the lists."""
    at = defaultdict(list)
    for station, day, element, value in observations:
        at[station, day].append((element, value))

    def qualifies(seen):
        element, value = seen
        starts = element is not None and element.startswith(("WD", "WS", "PRCP", "SNOW", "SNWD"))
        return bool(starts and value)

    def name(element):
        if element is None:
            return None
        return element if element.startswith(("WD", "WS", "PRCP", "SNOW", "SNWD")) else "SUNNY"

    found = {}
    for flight, orig, dest, day in flights:
        pairs = [
            (o, d) for o in at[orig, day] for d in at[dest, day] if qualifies(o) or qualifies(d)
        ]
        if pairs:
            found[flight] = tuple(
                Counter(name(pair[side][0]) for pair in pairs if pair[side][0]) for side in (0, 1)
            )
    return found


def label(elements):
    for name in buckets.WEATHER_PRIORITY[:-1]:
        if set(buckets.ELEMENTS_OF[name]) & set(elements):
            return name
    return "Sunny"


def test_equals_pairwise_rule(spark):
    chance = random.Random(7)
    stations = [f"s{i}" for i in range(12)]
    observations, flights = [], []
    days = [DAY + datetime.timedelta(days=i) for i in range(12)]
    for day in days:
        for station in stations:
            for _ in range(chance.choice([0, 1, 1, 2, 3])):
                value = chance.choice([0.0, 0.0, 1.0, None])
                observations.append((station, day, chance.choice(ELEMENTS), value))
    for i in range(600):
        flights.append((i, chance.choice(stations), chance.choice(stations), chance.choice(days)))
    expected = by_pairs(observations, flights)
    assert 100 < len(expected) < 600
    assert lists(spark, observations, flights) == expected
    labels = {i: (label(o), label(d)) for i, (o, d) in expected.items()}
    assert classes(spark, observations, flights) == labels
    assert classes(spark, observations, flights, small=False) == labels
    assert monthly_classes(spark, observations, flights) == labels
    assert monthly_classes(spark, observations, flights, small=False) == labels
