"""CSV round trips, drifting headers, compaction, views and checkpoints."""

import datetime
from collections import Counter

from pyspark.sql import functions as F

from aerolag import schemas, session
from aerolag.plans import cleaning, features
from aerolag.sources import readers, writers

HEADER = "FL_DATE,OP_CARRIER,ORIGIN,DEST,CRS_DEP_TIME,DEP_DELAY,Unnamed: 27"


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_flights_by_name_with_lenient_cells(spark, tmp_path):
    path = write(
        tmp_path / "2018.csv",
        HEADER,
        "2018-03-04,AA,JFK,LAX,0930.0,-3.0,",
        "bad,AA,JFK,LAX,,NULL,",
    )
    good, bad = readers.read_flights(spark, path).orderBy(F.desc_nulls_last("FL_DATE")).collect()
    assert good["FL_DATE"] == datetime.date(2018, 3, 4)
    assert (good["CRS_DEP_TIME"], good["DEP_DELAY"]) == (930, -3.0)
    assert (bad["FL_DATE"], bad["CRS_DEP_TIME"], bad["DEP_DELAY"]) == (None, None, None)


def test_folder_and_drifting_headers(spark, tmp_path):
    a = write(tmp_path / "f" / "2017.csv", HEADER, "2017-01-01,AA,JFK,LAX,900,1,")
    write(tmp_path / "f" / "2018.csv", HEADER, "2018-01-01,UA,JFK,LAX,900,2,")
    b = write(tmp_path / "g.csv", "DEST,FL_DATE,ARR_DELAY", "BOS,2019-01-01,4")
    assert readers.read_flights(spark, str(tmp_path / "f")).count() == 2
    both = readers.read_flights(spark, [a, b])
    assert both.where("DEST = 'BOS'").first()["ORIGIN"] is None
    assert both.where("DEST = 'BOS'").first()["ARR_DELAY"] == 4.0


def test_folder_with_columns_in_another_order(spark, tmp_path):
    write(tmp_path / "f" / "2017.csv", "FL_DATE,OP_CARRIER,ORIGIN,DEST", "2017-01-01,AA,JFK,LAX")
    write(tmp_path / "f" / "2018.csv", "FL_DATE,DEST,OP_CARRIER,ORIGIN", "2018-01-01,LAX,AA,JFK")
    flights = readers.read_flights(spark, str(tmp_path / "f"))
    rows = flights.select("OP_CARRIER", "ORIGIN", "DEST").collect()
    assert [tuple(row) for row in rows] == [("AA", "JFK", "LAX")] * 2


def test_training_rows_read_unknown_areas_as_zero(spark, tmp_path):
    path = write(tmp_path / "t.csv", "1,S77,3,4,1,1,2,2,5", "2,1,,4,1,1,2,2,6")
    rows = sorted(tuple(row) for row in readers.read_training_rows(spark, path).collect())
    assert rows == [(1, 0, 3, 4, 1, 1, 2, 2, 5), (2, 1, 0, 4, 1, 1, 2, 2, 6)]


def test_dimension_files(spark, tmp_path):
    stations = readers.read_stations(spark, write(tmp_path / "s.csv", "S1,40.5,-73.9,11.0", "S2,x,1,2"))
    assert sorted(stations.select("STATION", "LAT").collect()) == [("S1", 40.5), ("S2", None)]
    weather = readers.read_weather(
        spark,
        write(
            tmp_path / "w.csv",
            "STATION_ID,DATE,ELEMENT,DATA_VALUE,M_FLAG",
            "S1,20180304,PRCP,3,",
            "S1,junk,PRCP,,",
        ),
    )
    days = {row["OBS_DATE"]: row["DATA_VALUE"] for row in weather.collect()}
    assert days == {datetime.date(2018, 3, 4): 3.0, None: None}
    bridge = readers.read_airports_stations(
        spark, write(tmp_path / "b.csv", "ORIGIN,STATE,CITY,NAME,STATION", "JFK,NY,NYC,Kennedy,S1")
    )
    carriers = readers.read_carriers(spark, write(tmp_path / "c.csv", "OP_CARRIER,CATEGORY", "AA,Normal"))
    airports = readers.read_airports(
        spark,
        write(
            tmp_path / "a.csv",
            "ident,name,local_region,municipality,local_code,iata_code",
            "KJFK,Kennedy,NY,NYC,JFK,JFK",
        ),
    )
    assert airports.columns == list(schemas.AIRPORTS)
    flights = readers.read_flights(
        spark,
        write(
            tmp_path / "f.csv",
            "FL_DATE,OP_CARRIER,OP_CARRIER_FL_NUM,ORIGIN,DEST,CRS_DEP_TIME,DEP_DELAY,CRS_ARR_TIME,ARR_DELAY",
            "2018-03-04,AA,1,JFK,JFK,930,70,1830,-20",
        ),
    )
    table = features.feature_table(flights, bridge, stations, weather, carriers)
    assert [tuple(row) for row in table.collect()] == [(3, "1", "1", 9, 3, 1, 1, 1, 3)]
    labels = features.feature_table(flights, bridge, stations, weather, carriers, labels=True)
    assert labels.first().asDict()["ARR_DELAY_CAT"] == "15~30min early"


def test_round_trips(spark, tmp_path):
    rows = spark.range(100).select(*[(F.col("id") % (i + 2)).cast("int").alias(n) for i, n in enumerate(schemas.TRAINING_ROW.names)])
    expected = Counter(tuple(row) for row in rows.collect())
    bare = str(tmp_path / "bare")
    writers.write_table(rows, bare, header=False)
    assert Counter(tuple(r) for r in readers.read_training_rows(spark, bare).collect()) == expected
    headed, one = str(tmp_path / "headed"), str(tmp_path / "one")
    writers.write_table(rows, headed, files=3)
    writers.compact(spark, headed, one, files=1)
    again = readers.read_training_rows(spark, one, header=True)
    assert Counter(tuple(r) for r in again.collect()) == expected
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    years = rows.withColumn("YEAR", F.col("CARRIER_TYPE") + 2009)
    parted = str(tmp_path / "years")
    writers.write_table(years, parted, fmt="parquet", partition_by=["YEAR"])
    assert spark.read.parquet(parted).where("YEAR = 2010").count() == 50


def test_views_and_parameters(spark):
    table = spark.createDataFrame([("JFK", 1), ("x' OR '1'='1", 2)], "ORIGIN string, v int")
    readers.register_views(spark, {"seen": table})
    assert spark.sql("SELECT count(*) AS n FROM seen").first()["n"] == 2
    from aerolag.operators.explore import flights_from

    assert [row["v"] for row in flights_from(table, "x' OR '1'='1").collect()] == [2]


def test_cleaned_flights_keep_known_columns(spark):
    raw = spark.createDataFrame(
        [("AA", "None", "151.0"), ("AA", "12.9", "150.0"), ("NULL", None, "")],
        "OP_CARRIER string, ARR_TIME string, DEP_DELAY string",
    )
    rows = sorted(tuple(row) for row in cleaning.cleaned_flights(raw).select("OP_CARRIER", "DEP_DELAY", "ARR_TIME").collect())
    assert rows == [("0", 0, 0), ("AA", 150, 12)]


def test_checkpoint_cuts_lineage(spark):
    frame = session.checkpointed(spark.range(10).selectExpr("id * 2 AS v"))
    assert "Range" not in frame._jdf.queryExecution().toString()
    assert frame.agg(F.sum("v")).first()[0] == 90


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    orders = [["FL_DATE", "ORIGIN", "DEST"], ["DEST", "FL_DATE", "ORIGIN"], ["ORIGIN", "DEST"]]
    for i in range(60):
        names = orders[i % 3]
        cells = {"FL_DATE": "2018-01-01", "ORIGIN": f"O{i}", "DEST": f"D{i}"}
        write(tmp_path / "f" / f"y {i}%.csv", ",".join(names), *[",".join(cells[n] for n in names)] * 3)
    (tmp_path / "f" / "empty.csv").write_text("")
    folder = str(tmp_path / "f")
    tracker, group = spark.sparkContext.statusTracker(), "headers"
    spark.sparkContext.setJobGroup(group, group)
    found = readers.headers(spark, [folder]).collect()
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert jobs == 1 and len(found) == 60 and {row["header"] for row in found} == {",".join(o) for o in orders}
    flights = readers.read_flights(spark, folder)
    rows = flights.select("ORIGIN", "DEST").distinct().collect()
    assert {tuple(row) for row in rows} == {(f"O{i}", f"D{i}") for i in range(60)}
    assert flights.count() == 180 and flights.where("FL_DATE IS NULL").count() == 60


def test_a_long_file_is_not_read_for_its_header(spark, tmp_path):
    path = write(tmp_path / "long.csv", "a,b", *["1,2"] * 400_000)
    assert [row["header"] for row in readers.headers(spark, [path]).collect()] == ["a,b"]


def test_years_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "years")
    rows = spark.range(90).selectExpr("id", "CAST(2010 + id % 3 AS INT) AS YEAR")
    writers.write_years(rows, path)
    kept = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "years" / "data").glob("YEAR=201[02]/*")}
    writers.write_years(rows.where("YEAR = 2011 AND id < 31").withColumn("id", F.col("id") + 1000), path)
    assert {f.name: f.stat().st_mtime_ns for f in (tmp_path / "years" / "data").glob("YEAR=201[02]/*")} == kept
    audit = {row["YEAR"]: (row["rows"], row["found"]) for row in writers.audit_years(spark, path).collect()}
    assert audit == {2010: (30, 30), 2011: (10, 10), 2012: (30, 30)}
    failing = rows.where("YEAR = 2012").withColumn("id", F.expr("IF(id > 80, raise_error('lost'), id)").cast("long"))
    try:
        writers.write_years(failing, path)
        raise AssertionError("the write should fail")
    except Exception as error:
        assert "lost" in str(error)
    assert readers_of_year(spark, path, 2012) == 30


def readers_of_year(spark, path, year):
    return writers.read_years(spark, path).where(F.col("YEAR") == year).count()


def test_one_scan_gives_every_exploration(spark):
    from aerolag.operators import explore

    causes = ", ".join(f"CAST(id % {i + 2} AS DOUBLE) AS {name}" for i, name in enumerate(explore.CAUSES))
    flights = spark.range(500).selectExpr(
        "concat('A', id % 7) AS ORIGIN", "IF(id % 11 = 0, NULL, concat('C', id % 4)) AS OP_CARRIER",
        "date_add(DATE'2018-01-01', CAST(id AS INT)) AS FL_DATE", "CAST(id % 40 - 20 AS DOUBLE) AS DEP_DELAY", causes.split(", ")[0],
        *causes.split(", ")[1:],
    )
    found = explore.explored(flights)
    single = {"airports": explore.airport_delay, "carriers": explore.carrier_month_delay, "causes": explore.delay_causes}
    for part, alone in single.items():
        expected = alone(flights)
        rows = explore.explored_part(found, part).select(*expected.columns).collect()
        near = lambda rs: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rs)
        assert near(rows) == near(expected.collect())
    assert found._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
