"""Bucket edges, missing markers and casts on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from aerolag.functions import buckets, clean


def one_column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, kind, expression):
    rows = one_column(spark, values, kind).select("i", expression.alias("r")).orderBy("i").collect()
    return [row["r"] for row in rows]


def test_delay_edges(spark):
    delays = [-61, -60, -30, -15, -5, 5, 6, 15, 16, 30, 31, 60, 61, None, 5.7, -30.5]
    delays = [None if d is None else float(d) for d in delays]
    expected = [1, 2, 3, 4, 5, 5, 6, 6, 7, 7, 8, 8, 9, 5, 6, 2]
    assert apply(spark, delays, "double", buckets.delay_code(F.col("v"))) == expected
    labels = apply(spark, delays, "double", buckets.delay_label(F.col("v")))
    assert labels == [buckets.DELAY_LABELS[code] for code in expected]


def test_delay_reads_text(spark):
    texts = ["-60.0", "61", "", "NULL", None]
    assert apply(spark, texts, "string", buckets.delay_code(F.col("v"))) == [2, 9, 5, 5, 5]


def test_schedule_edges(spark):
    times = [559, 600, 759, 800, 1759, 1800, None]
    assert apply(spark, times, "int", buckets.schedule_code(F.col("v"))) == [1, 2, 2, 3, 3, 1, 1]


AREAS = [
    (36, 79, "SE", 5),
    (37, 79, "NE", 1),
    (36, 80, "MSE", 6),
    (49, 94, "MNE", 2),
    (36, 109, "MSW", 7),
    (49, 109, "MNW", 3),
    (36, 124, "SW", 8),
    (49, 124, "NW", 4),
    (61, 150, "NW", 4),
    (21, 157, "SW", 8),
    (13, -144, "SE", 5),
    (61, 70, "NE", 1),
    (50, 100, "here", None),
    (50, 70, "here", None),
    (40, 130, "here", None),
    (36, 125, "here", None),
    (None, None, "here", None),
]


def test_area_edges(spark):
    rows = [(i, None if a is None else float(a), None if o is None else float(o)) for i, (a, o, *_) in enumerate(AREAS)]
    df = spark.createDataFrame(rows, "i int, lat double, lon double")
    result = df.select(
        "i",
        buckets.area_label(F.col("lat"), F.col("lon"), F.lit("here")).alias("label"),
        buckets.area_code(F.col("lat"), F.col("lon")).alias("code"),
    ).orderBy("i")
    assert [(r["label"], r["code"]) for r in result.collect()] == [(a[2], a[3]) for a in AREAS]


def test_carrier_spellings(spark):
    names = ["ULLC", "ULCC", "LCC", "Normal", "other", None]
    assert apply(spark, names, "string", buckets.carrier_code(F.col("v"))) == [1, 1, 2, 3, None, None]


def test_weather_elements(spark):
    codes = ["SNOW", "SNWD", "PRCP", "WDF2", "WDF5", "WSF2", "WT18", "TMAX", "XPRCP", None]
    ranks = apply(spark, codes, "string", buckets.weather_label(buckets.weather_rank(F.col("v"))))
    assert ranks == ["Snow", "Snow", "Rain", "Wind", "Wind", *["Sunny"] * 5]
    elements = apply(spark, codes, "string", buckets.weather_element(F.col("v")))
    assert elements == ["SNOW", "SNWD", "PRCP", "WDF2", "WDF5", "WSF2", "SUNNY", "SUNNY", "XPRCP", None]


def test_missing_markers(spark):
    cells = ["None", "NULL", "", None, "NaN", "AA", "xNULLy", "12"]
    cleaned = clean.clean_missing(one_column(spark, cells, "string")).orderBy(F.col("i").cast("int"))
    assert [row["v"] for row in cleaned.collect()] == ["0", "0", "0", "0", "0", "AA", "0", "12"]


def test_int_cast_goes_through_double(spark):
    texts = ["-60.0", "7.9", "AA", "", None]
    rows = clean.cast_ints(one_column(spark, texts, "string"), ["v"]).orderBy("i").collect()
    assert [row["v"] for row in rows] == [-60, 7, None, None, None]


def test_null_audit_counts_nan_and_null(spark):
    row = clean.null_audit(one_column(spark, ["NaN", None, "AA", "1"], "string")).first()
    assert (row["v_nan"], row["v_missing"]) == (1, 2)


@pytest.mark.parametrize("kind", ["delay", "schedule"])
def test_row_wise_functions_accept_streams(spark, tmp_path, kind):
    source = str(tmp_path / "in")
    spark.range(100).select((F.col("id") * 20).cast("double").alias("v")).write.parquet(source)
    code = buckets.delay_code if kind == "delay" else buckets.schedule_code
    stream = spark.readStream.schema("v double").parquet(source).select("v", code(F.col("v")).alias("c"))
    target, name = str(tmp_path / "out"), str(tmp_path / "check")
    run = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", name)
        .trigger(availableNow=True)
        .start(target)
    )
    run.awaitTermination(120)
    batch = spark.read.parquet(source).select("v", code(F.col("v")).alias("c"))
    assert sorted(spark.read.parquet(target).collect()) == sorted(batch.collect())
