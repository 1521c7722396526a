"""Laid-out storage: the same features, and what the plan moves."""

import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aerolag.operators import weather
from aerolag.plans import features, layout
from aerolag.sources import testtables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    """The plan that ran or is to run, once."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def inputs(spark):
    read = (testtables.flights, testtables.airports_stations, testtables.stations, testtables.weather, testtables.carriers)
    return [make(spark, FOLDER) for make in read]


def test_same_features_and_one_exchange(spark, inputs, tmp_path):
    name = f"layout_{uuid.uuid4().hex}"
    layout.lay_out(*inputs, name, str(tmp_path / "l"), buckets=16)
    table = layout.features(spark, name)
    expected = Counter(tuple(r) for r in features.feature_table(*inputs).collect())
    assert sum(expected.values()) > 100 and Counter(tuple(r) for r in table.collect()) == expected
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", plan_of(table))
    assert moved == ["DEST_STATION"] and "Broadcast" not in plan_of(table)
    origin_only = weather.join_both_ends(spark.table(f"{name}_flights"), spark.table(f"{name}_daily"), laid_out=True)
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan_of(origin_only))) == {"DEST_STATION"}
    again = f"layout_{uuid.uuid4().hex}"
    layout.open_layout(spark, again, str(tmp_path / "l"), 16)
    reopened = layout.features(spark, again)
    assert Counter(tuple(r) for r in reopened.collect()) == expected
    assert plan_of(reopened).count("Exchange hashpartitioning") == 1
    for known in (name, again):
        for kind in layout.KEYS:
            spark.sql(f"DROP TABLE {known}_{kind}")


def test_a_hot_station_day_is_refused(spark, inputs, tmp_path):
    flights, *rest = inputs
    one = flights.withColumns({"ORIGIN": F.lit("A1"), "FL_DATE": F.lit("2024-01-02").cast("date")})
    with pytest.raises(ValueError):
        layout.lay_out(one, *rest, f"layout_{uuid.uuid4().hex}", str(tmp_path / "l"), buckets=64)
