"""Jobs over all flights compute them once, and leave behind only what is read again."""

import time

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.catalog.queries import QUERIES
from aerolag.operators import rank
from aerolag.plans import boosting, features, models
from aerolag.session import discard, new_folder, stored
from aerolag.sources import testtables

ORDERS = 300
LINES = 4
COUNT = {"events": 800, "orders": ORDERS, "part": 50, "lineitem": ORDERS * LINES}
ROWS = {
    "events": {"event_id": "id", "ts": "timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id % 30 AS INT))", "user_id": "id % 11",
               "event_type": "element_at(array('click', 'view', 'error'), CAST(id % 3 + 1 AS INT))", "value": "id % 5 * 20D", "props": "''"},
    "orders": {"o_orderkey": "id + 1", "o_custkey": "id % 29", "o_orderstatus": "'F'", "o_totalprice": "1D",
               "o_orderdate": "timestamp_ntz'1995-01-01' + make_dt_interval(CAST(id % 200 AS INT))", "o_orderpriority": "'1'"},
    "part": {"p_partkey": "id", "p_name": "'p'", "p_brand": "concat('Brand#', id % 9)", "p_type": "'t'", "p_size": "1", "p_retailprice": "1D"},
    "lineitem": {"l_orderkey": f"id % {ORDERS} + 1", "l_partkey": "id * 7 % 50", "l_suppkey": "id % 17", "l_linenumber": f"CAST(id / {ORDERS} AS INT)",
                 "l_quantity": "id * 11 % 50 + 1D", "l_extendedprice": "id * 13 % 700 + 0.5D", "l_discount": "0.05D", "l_tax": "0.02D",
                 "l_returnflag": "if(id % 3 = 0, 'R', 'N')", "l_linestatus": "if(id % 2 = 0, 'F', 'O')", "l_shipdate": "timestamp_ntz'1995-01-01'"},
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    for name, columns in ROWS.items():
        names = [field.split()[0] for field in testtables.SCHEMAS[name].split(", ")]
        rows = spark.range(COUNT[name]).select(*[F.expr(columns[column]).alias(column) for column in names])
        rows.to(spark.createDataFrame([], testtables.SCHEMAS[name]).schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture
def computed(spark, monkeypatch):
    """Counts the flights that are computed, however often."""
    seen = spark.sparkContext.accumulator(0)
    plain = testtables.flights

    def flights(*args, **options):
        def passed(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        found = plain(*args, **options)
        return found.mapInArrow(passed, found.schema)

    monkeypatch.setattr(testtables, "flights", flights)
    return seen


@pytest.mark.parametrize("name", ["score_requests", "request_errors", "linear_regression", "logistic_classes"])
def test_flights_are_computed_once(spark, folder, computed, name):
    assert QUERIES[name](spark, folder).collect()
    assert computed.value == COUNT["lineitem"]


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return disk.getAllFiles().size()


def test_stored_rows_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = stored(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n")), path := new_folder(spark, "once"))
    for _ in range(100):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert rows.agg(F.sum("n")).first()[0] == 5000
    discard(spark, path)
    with pytest.raises(Exception, match="(?i)not.exist|not found|FileNotFound"):
        spark.read.schema(rows.schema).parquet(path).count()


def explained(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_codes_are_the_same_broadcast_and_shuffled(spark):
    df = spark.range(500).select((F.col("id") % 90).cast("string").alias("a"), F.when(F.col("id") % 3 > 0, "x").alias("b"))
    codes = rank.dense_codes(df.where("a < '7'"), ["a", "b"])
    near, far = (rank.encode(df, codes, {"a": "p", "b": "q"}, max_rows=n) for n in (1000, 0))
    assert sorted(map(str, near.collect())) == sorted(map(str, far.collect()))
    shown = near._jdf.queryExecution().toString()
    assert "_salt" not in shown and "_salt" in far._jdf.queryExecution().toString()


def test_weather_lists_shuffle_flights_once_to_count_them(spark, folder, monkeypatch):
    inputs = [build(spark, folder) for build in (testtables.flights, testtables.airports_stations, testtables.stations, testtables.weather)]
    written = []
    monkeypatch.setattr(features, "stored", lambda df: written.append(df) or stored(df))
    airports = inputs[1].count()
    # All broadcast, airports only, and none.
    found = [features.weather_lists(*inputs, max_rows=n) for n in (1000, airports, 0)]
    assert len({str(sorted(map(str, lists.select(*sorted(lists.columns)).collect()))) for lists in found}) == 1
    assert found[0].count() > 100
    counted = [shown for df in written if "copies" in df.columns and "hashpartitioning(FL_DATE" in (shown := explained(df))]
    # Beyond the airports that are broadcast they are counted twice, before the lookups and after.
    assert [shown.count("hashpartitioning(FL_DATE") for shown in counted] == [1, 1, 1]
    assert ["_salt" in shown for shown in counted] == [False, False, True]


def test_boosting_caches_nothing_and_deletes_what_it_stored(spark, tmp_path, monkeypatch):
    rows = spark.range(200).selectExpr("CAST(id % 11 AS DOUBLE) AS a", "id % 7 AS b", "IF(id % 40 = 0, NULL, id % 11 * 2D + id % 5) AS y")
    monkeypatch.setattr(boosting, "new_folder", lambda spark, kind: f"{tmp_path}/{kind}")
    monkeypatch.setattr(DataFrame, "persist", lambda *_: pytest.fail("the rows are cached beside what is stored"))
    fits, weights = boosting.boost(rows, ["a", "b"], "y", 3)
    assert len(fits) == len(weights) > 0 and not list(tmp_path.iterdir())


def test_logistic_rows_are_not_cached_beside_the_vectors(spark, monkeypatch):
    rows = spark.range(200).selectExpr("CAST(id % 5 AS INT) AS v", "id % 10 * 1D AS x", "CAST(id % 5 >= 2 AS DOUBLE) AS label")
    codes = spark.createDataFrame([("v", str(i), i) for i in range(5)], "name string, value string, code int")
    monkeypatch.setattr(DataFrame, "persist", lambda *_: pytest.fail("the rows are cached beside the vectors made of them"))
    model = models.fit_logistic_sparse(rows, codes, ["v"], ["x"], "label", 5)
    assert model.transform(rows).where("prediction = label").count() == 200
