"""Lookup joins: every way gives the same rows, and plans stay free of nested loops."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from aerolag.operators import joins, places, weather
from aerolag.plans import features
from aerolag.sources import testtables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def bag(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, many of them exact copies; some have no key."""
    rows = [("hot", 0)] * 200 + [("hot", i) for i in range(100)]
    rows += [(f"k{i % 40}", i) for i in range(500)] + [(None, i) for i in range(100)]
    return spark.createDataFrame(rows, "k string, v int")


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("hot", "a"), ("hot", "b")] + [(f"k{i}", str(i)) for i in range(30)] + [(None, "n")]
    return spark.createDataFrame(rows, "k string, w string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(skewed, dim, how):
    expected = bag(skewed.join(dim, "k", how))
    assert bag(joins.lookup_join(skewed, dim, ["k"], how, small=False, share=5, salts=8)) == expected
    assert bag(joins.lookup_join(skewed, dim, ["k"], how, small=True)) == expected


def test_hot_keys_are_bounded_and_found(skewed):
    assert [row["k"] for row in joins.hot_keys(skewed, ["k"], share=5).collect()] == ["hot"]
    assert joins.hot_keys(skewed, ["k"], share=100).count() <= 100


def test_size_check(dim):
    assert joins.fits_broadcast(dim, dim.limit(3), max_rows=10) == [False, True]
    assert joins.fits_broadcast(dim, max_bytes=5) == [False]


def test_feature_job_is_the_same_without_broadcast(spark):
    inputs = [
        build(spark, FOLDER)
        for build in (
            testtables.flights,
            testtables.airports_stations,
            testtables.stations,
            testtables.weather,
            testtables.carriers,
        )
    ]
    broadcast = features.feature_table(*inputs)
    shuffled = features.feature_table(*inputs, max_rows=0)
    assert bag(broadcast) == bag(shuffled)


def test_feature_job_looks_weather_up_by_month(spark):
    """More station-days than are broadcast, fewer months: the flights are not salted, nor computed again."""
    inputs = [
        build(spark, FOLDER)
        for build in (
            testtables.flights,
            testtables.airports_stations,
            testtables.stations,
            testtables.weather,
        )
    ]
    daily = weather.daily_weather(inputs[3])
    monthly = weather.monthly_weather(daily)
    months, days = monthly.count(), daily.count()
    assert days > 5 * months and monthly.select("STATION", "MONTH").distinct().count() == months
    carriers = testtables.carriers(spark, FOLDER)
    within = features.feature_table(*inputs, carriers, max_rows=2 * months)
    assert "_salt" not in plan(within) and bag(within) == bag(features.feature_table(*inputs, carriers, max_rows=0))
    network = features.network_table(*inputs, max_rows=2 * months)
    assert "_salt" not in plan(network) and bag(network) == bag(features.network_table(*inputs, max_rows=0))


def test_feature_job_broadcasts_lookups_of_many_stations(spark, monkeypatch):
    """More airports and months of stations than other lookups broadcast: the flights are shuffled once."""

    def located(*_):
        raise AssertionError("flights are stored and shuffled for the lookups")

    monkeypatch.setattr(features, "located_flights", located)
    many = joins.BROADCAST_ROWS + 1000
    at = spark.range(many).selectExpr("concat('S', id) AS STATION", "concat('A', id) AS ORIGIN", "id")
    weather_rows = at.selectExpr("STATION AS STATION_ID", "date'2024-01-02' AS OBS_DATE", "'PRCP' AS ELEMENT", "1D AS DATA_VALUE")
    raw = [f"1 AS {name}" for name in features.RAW_KEYS[2:]]
    flown = spark.range(6).selectExpr(
        "date'2024-01-02' AS FL_DATE", "concat('C', id % 3) AS OP_CARRIER", *raw,
        "concat('A', id * 1000) AS ORIGIN", f"concat('A', if(id = 5, {many}, {many - 1} - id)) AS DEST",
    )
    inputs = [flown, at.select("ORIGIN", "STATION"), at.selectExpr("STATION", "40D AS LAT", "-80D AS LON"), weather_rows]
    carriers = spark.createDataFrame([("C0", "LCC")], "OP_CARRIER string, CATEGORY string")
    assert features.feature_table(*inputs, carriers).count() == 5
    assert features.network_table(*inputs).count() == 5


@pytest.fixture(scope="module")
def served(spark):
    """Airports of no, one and two stations, stations of two airports or without weather, rows that come twice."""
    at = [("A", "s1"), ("A", "s2"), ("B", "s1"), ("B", "s1"), ("C", "s3"), ("D", None), (None, "s2"), ("E", "s4")]
    seen = [
        ("s1", "2024-01-02", "PRCP", 3.0), ("s1", "2024-02-02", "TMAX", 0.0), ("s2", "2024-01-02", "TMAX", 5.0),
        ("s2", "2024-01-31", "SNOW", 1.0), ("s3", "2024-01-02", "WDF2", 0.0), ("s3", "2024-01-31", "TMAX", 2.0),
        (None, "2024-01-02", "PRCP", 1.0), ("s3", None, "PRCP", 1.0),
    ]
    days = ["2024-01-02", "2024-01-03", "2024-01-31", "2024-02-02", None]
    flown = [(day, one, other) for day in days for one in [*"ABCDEX", None] for other in [*"ABCDEX", None]]
    raw = [f"1 AS {name}" for name in features.RAW_KEYS[1:]]
    flights = spark.createDataFrame(flown + flown[:40], "FL_DATE string, ORIGIN string, DEST string")
    return (
        flights.selectExpr("cast(FL_DATE AS date) AS FL_DATE", *raw, "2 AS DIVERTED", "1 AS CANCELLED", "ORIGIN", "DEST"),
        spark.createDataFrame(at, "ORIGIN string, STATION string"),
        spark.createDataFrame([("s1", 40.0, -70.0), ("s2", 30.0, -90.0), ("s3", None, None)], "STATION string, LAT double, LON double"),
        spark.createDataFrame(seen, "STATION_ID string, OBS_DATE string, ELEMENT string, DATA_VALUE double").withColumn(
            "OBS_DATE", F.col("OBS_DATE").cast("date")
        ),
    )


def test_feature_job_shuffles_flights_once_per_end_for_its_lookups(spark, served, monkeypatch):
    shuffled = []

    def lookup(fact, dim, on, how="left", small=None, *rest):
        if not small:
            shuffled.append(on)
        return joins.lookup_join(fact, dim, on, how, small, *rest)

    monkeypatch.setattr(places, "lookup_join", lookup)
    monkeypatch.setattr(weather, "lookup_join", lookup)
    for status in (False, True):
        expected = bag(features.network_table(*served, keep_status=status))
        assert sum(expected.values()) == len(expected) == 8 and not shuffled
        assert bag(features.network_table(*served, keep_status=status, max_rows=0)) == expected
        assert shuffled == [["ORIGIN", "_month"], ["DEST", "_month"]]
        shuffled.clear()


@pytest.mark.parametrize("small_areas", [True, False])
@pytest.mark.parametrize("small_weather", [True, False])
def test_flights_meet_the_same_weather_by_any_lookup(served, small_areas, small_weather):
    flights, bridge, stations, observed = served
    areas = places.areas(places.station_geo(bridge, stations))
    monthly = weather.monthly_weather(weather.daily_weather(observed))
    expected = bag(features.met_flights(flights, areas, monthly, True, True).select(*features.END_KEYS, *features.RANK_KEYS, "FL_DATE"))
    met = features.met_flights(flights, areas, monthly, small_areas, small_weather)
    assert bag(met.select(*features.END_KEYS, *features.RANK_KEYS, "FL_DATE")) == expected
    # Pairs of stations on the days both have been observed and one has weather.
    assert {(r["ORIG_STATION"], r["DEST_STATION"], str(r["FL_DATE"])) for r in met.collect()} == {
        (one, other, "2024-01-02") for one in ("s1", "s2", "s3") for other in ("s1", "s2", "s3") if "s1" in (one, other)
    } | {(one, other, "2024-01-31") for one in ("s2", "s3") for other in ("s2", "s3") if "s2" in (one, other)}


def test_airport_lookup_has_no_nested_loop(spark):
    codes = places.airport_codes(testtables.flights(spark, FOLDER))
    text = plan(places.airport_directory(codes, testtables.airports(spark, FOLDER)))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_airport_lookup_cases(spark):
    codes = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",)], "ORIGIN string")
    airports = spark.createDataFrame(
        [("r", "m", "AAA", "AAA", "i1", "both"), ("r", "m", None, "BBB", "i2", "iata only")],
        "local_region string, municipality string, local_code string, iata_code string, ident string, name string",
    )
    found = places.airport_directory(codes, airports).select("ORIGIN", "NAME")
    assert bag(found) == Counter({("AAA", "both"): 1, ("BBB", "iata only"): 1, ("CCC", None): 1})


def test_feature_job_plan(spark):
    inputs = [
        build(spark, FOLDER)
        for build in (
            testtables.flights,
            testtables.airports_stations,
            testtables.stations,
            testtables.weather,
            testtables.carriers,
        )
    ]
    text = plan(features.feature_table(*inputs))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_station_with_two_airports_fans_out_and_dedupes(spark):
    areas = spark.createDataFrame(
        [("AAA", "s1", "NE", 1), ("BBB", "s1", "NE", 1), ("CCC", "s2", "SE", 5), ("CCC", "s3", "SE", 5)],
        "AIRPORT_CODE string, STATION string, AREA string, AREA_CODE int",
    )
    columns = [f"date'2018-01-02' {features.RAW_KEYS[0]}"] + [f"1 {name}" for name in features.RAW_KEYS[1:]]
    flights = spark.createDataFrame([("AAA", "CCC"), ("BBB", "CCC")], "ORIGIN string, DEST string")
    flights = flights.selectExpr("*", *columns)
    assert places.with_areas(flights, areas).count() == 4
    distinct = features.located_flights(flights, areas, True)
    assert distinct.count() == 2
    assert features.located_flights(flights, areas, False).count() == 2
    assert distinct.where(F.col("ORIG_STATION") == "s1").count() == 2
