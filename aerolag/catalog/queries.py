"""One query per operator, each over whole test tables.

Dates and arrays leave a query as text, so that every engine compares them alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.functions import buckets, clean
from aerolag.operators import explore, leastsquares, metrics, places, rank, regtree, scale, tree
from aerolag.plans import cleaning, features, layout, models, network, requests
from aerolag.schemas import LABEL
from aerolag.session import checkpoint_folder, checkpointed, stored
from aerolag.sources import readers, testtables, writers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Carriers reported side by side, and the origin examined, as query parameters.
PIVOT_CARRIERS = ["Brand#1", "Brand#10", "Brand#2"]
EXAMINED_ORIGIN = "A0"
DIGITS = 6


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _day(name: str = "FL_DATE") -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in names})


def _dimensions(spark: SparkSession, folder: str) -> tuple[DataFrame, ...]:
    return (
        testtables.flights(spark, folder),
        testtables.airports_stations(spark, folder),
        testtables.stations(spark, folder),
        testtables.weather(spark, folder),
    )


def _features(spark: SparkSession, folder: str, **options) -> DataFrame:
    carriers = testtables.carriers(spark, folder)
    return features.feature_table(*_dimensions(spark, folder), carriers, **options)


def _training_rows(spark: SparkSession, folder: str) -> DataFrame:
    return features.training_rows(_features(spark, folder))


def _geo(spark: SparkSession, folder: str) -> DataFrame:
    return places.station_geo(
        testtables.airports_stations(spark, folder), testtables.stations(spark, folder)
    )


# Scans and projections


@query
def scan_flights(spark: SparkSession, folder: str) -> DataFrame:
    return testtables.flights(spark, folder).withColumn("FL_DATE", _day())


@query
def project_flights(spark: SparkSession, folder: str) -> DataFrame:
    flights = testtables.flights(spark, folder)
    return flights.select(*features.RAW_KEYS, "ORIGIN", "DEST").withColumn("FL_DATE", _day())


@query
def tree_input(spark: SparkSession, folder: str) -> DataFrame:
    return _training_rows(spark, folder).withColumn("node_id", F.lit(tree.ROOT))


# Cleaning


@query
def clean_missing(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_missing(testtables.flights_raw(spark, folder))


@query
def clean_cast(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cleaned_flights(testtables.flights_raw(spark, folder))


@query
def null_audit(spark: SparkSession, folder: str) -> DataFrame:
    return clean.null_audit(testtables.flights_raw(spark, folder))


@query
def outlier_filter(spark: SparkSession, folder: str) -> DataFrame:
    raw = testtables.flights_raw(spark, folder)
    return explore.without_outliers(raw, 30).select("ORIGIN", "OP_CARRIER", "DEP_DELAY")


# Scalar buckets


@query
def delay_class(spark: SparkSession, folder: str) -> DataFrame:
    return testtables.flights(spark, folder).select(
        "DEP_DELAY",
        buckets.delay_code(F.col("DEP_DELAY")).alias("DEP_DELAY_CAT"),
        buckets.delay_label(F.col("DEP_DELAY")).alias("DEP_DELAY_LABEL"),
        "ARR_DELAY",
        buckets.delay_code(F.col("ARR_DELAY")).alias("ARR_DELAY_CAT"),
        buckets.delay_label(F.col("ARR_DELAY")).alias("ARR_DELAY_LABEL"),
    )


@query
def schedule_class(spark: SparkSession, folder: str) -> DataFrame:
    return testtables.flights(spark, folder).select(
        "CRS_DEP_TIME",
        buckets.schedule_code(F.col("CRS_DEP_TIME")).alias("ORIG_SCHEDULE"),
        buckets.schedule_label(F.col("CRS_DEP_TIME")).alias("ORIG_SCHEDULE_LABEL"),
    )


@query
def area_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return places.areas(_geo(spark, folder)).select("AIRPORT_CODE", "STATION", "AREA")


@query
def area_bucket_int(spark: SparkSession, folder: str) -> DataFrame:
    return places.areas(_geo(spark, folder)).select("AIRPORT_CODE", "STATION", "AREA_CODE")


@query
def flight_datekey(spark: SparkSession, folder: str) -> DataFrame:
    key = F.date_format("FL_DATE", readers.WEATHER_DATE_FORMAT).alias("DATE_KEY")
    return testtables.flights(spark, folder, calendar=True).groupBy(key).agg(F.count("*").alias("n"))


@query
def month_day(spark: SparkSession, folder: str) -> DataFrame:
    dated = explore.month_and_day(testtables.flights(spark, folder, calendar=True))
    return dated.select("ORIGIN", "DEST", "OP_CARRIER", "ARR_DELAY", "MONTH", "DAY")


@query
def flights_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """All years as one table with their year, as it is written partitioned."""
    flights = testtables.flights(spark, folder, calendar=True)
    return flights.select("OP_CARRIER", "ORIGIN", "DEST", "ARR_DELAY", F.year("FL_DATE").alias("YEAR"))


@query
def years_rewritten(spark: SparkSession, folder: str) -> DataFrame:
    """All years written, every second one written again, and the manifest against what is there."""
    flights = testtables.flights(spark, folder, calendar=True)
    years = flights.select("OP_CARRIER", "ORIGIN", "DEST", "ARR_DELAY", F.year("FL_DATE").alias("YEAR"))
    path = f"{checkpoint_folder(spark)}/years-{uuid.uuid4().hex}"
    writers.write_years(years, path)
    writers.write_years(years.where("YEAR % 2 = 0"), path)
    return writers.audit_years(spark, path)


# Exploration


@query
def delay_extremes(spark: SparkSession, folder: str) -> DataFrame:
    return explore.delay_extremes(testtables.flights_raw(spark, folder).replace("NaN", None))


@query
def airport_delay(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(explore.airport_delay(testtables.flights(spark, folder)), "delay")


@query
def top_delay_airports(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(explore.top_delay_airports(testtables.flights(spark, folder)), "delay")


@query
def flights_from_origin(spark: SparkSession, folder: str) -> DataFrame:
    chosen = explore.flights_from(testtables.flights(spark, folder), EXAMINED_ORIGIN)
    return chosen.agg(F.count("*").alias("n"))


@query
def carrier_month_delay(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(explore.carrier_month_delay(testtables.flights(spark, folder, calendar=True)), "avgDelay")


@query
def origin_carrier_month(spark: SparkSession, folder: str) -> DataFrame:
    chosen = explore.flights_from(testtables.flights(spark, folder, calendar=True), EXAMINED_ORIGIN)
    return _rounded(explore.carrier_month_delay(chosen), "avgDelay")


@query
def carrier_month_pivot(spark: SparkSession, folder: str) -> DataFrame:
    flights = testtables.flights(spark, folder, calendar=True)
    return _rounded(explore.carrier_month_pivot(flights, PIVOT_CARRIERS), *PIVOT_CARRIERS)


@query
def delay_causes(spark: SparkSession, folder: str) -> DataFrame:
    return explore.delay_causes(testtables.flights(spark, folder))


@query
def explored_at_once(spark: SparkSession, folder: str) -> DataFrame:
    """Airports, carriers by month, and causes, from one scan of the flights."""
    found = explore.explored(testtables.flights(spark, folder, calendar=True))
    return _rounded(found, "delay", "avgDelay")


@query
def carriers_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return explore.carriers_of(testtables.flights(spark, folder))


@query
def airport_codes(spark: SparkSession, folder: str) -> DataFrame:
    return places.airport_codes(testtables.flights(spark, folder))


# Dimension joins


@query
def airport_lookup_or(spark: SparkSession, folder: str) -> DataFrame:
    codes = places.airport_codes(testtables.flights(spark, folder))
    return places.airport_directory(codes, testtables.airports(spark, folder))


@query
def weather_at_airports(spark: SparkSession, folder: str) -> DataFrame:
    observed = places.weather_at_airports(
        testtables.weather(spark, folder), testtables.airports_stations(spark, folder)
    )
    return observed.withColumn("OBS_DATE", _day("OBS_DATE"))


@query
def station_geo(spark: SparkSession, folder: str) -> DataFrame:
    return _geo(spark, folder)


@query
def geo_extremes(spark: SparkSession, folder: str) -> DataFrame:
    return places.geo_extremes(_geo(spark, folder))


@query
def flight_areas(spark: SparkSession, folder: str) -> DataFrame:
    flights = testtables.flights(spark, folder).select(
        _day(), "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST"
    )
    return places.with_areas(flights, places.areas(_geo(spark, folder)))


@query
def carrier_type(spark: SparkSession, folder: str) -> DataFrame:
    flights = testtables.flights(spark, folder).select("OP_CARRIER", "OP_CARRIER_FL_NUM")
    typed = places.with_carrier_type(flights, testtables.carriers(spark, folder))
    return typed.withColumn("CARRIER_TYPE_CODE", buckets.carrier_code(F.col("CARRIER_TYPE")))


# Weather and feature tables


@query
def weather_class(spark: SparkSession, folder: str) -> DataFrame:
    table = features.network_table(*_dimensions(spark, folder))
    return table.groupBy("ORIG_WEATHER", "DEST_WEATHER").agg(F.count("*").alias("n"))


@query
def weather_lists(spark: SparkSession, folder: str) -> DataFrame:
    lists = {}
    for end in ("ORIG", "DEST"):
        entries = F.array_sort(F.map_entries(f"{end}_WEATHERS"))
        said = F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
        lists[f"{end}_WEATHERS"] = F.array_join(said, ",")
    listed = features.weather_lists(*_dimensions(spark, folder))
    return listed.withColumns(lists).withColumn("FL_DATE", _day())


@query
def features_int(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder)


@query
def features_int_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same table with every lookup shuffled, as beyond the size that is broadcast."""
    return _features(spark, folder, max_rows=0)


@query
def features_int_laid_out(spark: SparkSession, folder: str) -> DataFrame:
    """The same table from flights and daily weather that were written in buckets of their keys."""
    name = f"layout_{uuid.uuid4().hex}"
    carriers = testtables.carriers(spark, folder)
    layout.lay_out(*_dimensions(spark, folder), carriers, name, f"{checkpoint_folder(spark)}/{name}")
    return layout.features(spark, name)


@query
def features_str(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder, labels=True)


@query
def features_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder, with_year=True)


@query
def features_nn(spark: SparkSession, folder: str) -> DataFrame:
    return features.network_table(*_dimensions(spark, folder)).withColumn("FL_DATE", _day())


@query
def features_nn_status(spark: SparkSession, folder: str) -> DataFrame:
    table = features.network_table(*_dimensions(spark, folder), keep_status=True)
    return table.withColumn("FL_DATE", _day())


@query
def split_90_10(spark: SparkSession, folder: str) -> DataFrame:
    return rank.split_exact(_training_rows(spark, folder))


@query
def random_split(spark: SparkSession, folder: str) -> DataFrame:
    flights = testtables.flights(spark, folder).select(
        "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME"
    )
    train, test = models.split(flights, 0.25, 5)
    sides = train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test")))
    return sides.groupBy("split").agg(F.count("*").alias("n"))


# Decision tree


@query
def label_entropy(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(tree.label_entropy(_training_rows(spark, folder)), "entropy")


@query
def information_gain(spark: SparkSession, folder: str) -> DataFrame:
    gains = tree.information_gain(_training_rows(spark, folder))
    return _rounded(gains, "h_y", "h_y_x", "gain")


@query
def best_split_root(spark: SparkSession, folder: str) -> DataFrame:
    best = tree.best_split(tree.information_gain(_training_rows(spark, folder)))
    return _rounded(best, "gain")


@query
def node_mode(spark: SparkSession, folder: str) -> DataFrame:
    return tree.mode_by(_training_rows(spark, folder), ["DEP_DELAY_CAT", "ORIG_WEATHER"])


@query
def tree_level_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Counts behind the splits of the first level below the root."""
    root = tree.at_root(_counted_rows(spark, folder))
    nodes = tree.level_nodes(root, 0, tree.TreeRules())
    return tree.attribute_counts(tree.descend(root, tree.splits_of(nodes)))


def _counted_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct training rows with their counts, stored: the feature job runs once per query."""
    return checkpointed(tree.compact(_training_rows(spark, folder)))


def _scored_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = _counted_rows(spark, folder)
    return tree.score_tree(tree.grow_counted(counted), counted)


@query
def tree_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(tree.grow_tree(_training_rows(spark, folder)), "h_y")


@query
def tree_score(spark: SparkSession, folder: str) -> DataFrame:
    """Every training row with its leaf: distinct rows are scored, then repeated."""
    return rank.expand(_scored_counts(spark, folder), "n")


@query
def tree_score_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same scores with the tree's edges joined by shuffles."""
    counted = _counted_rows(spark, folder)
    return rank.expand(tree.score_tree(tree.grow_counted(counted), counted, small=False), "n")


@query
def tree_text(spark: SparkSession, folder: str) -> DataFrame:
    return tree.tree_text(tree.grow_tree(_training_rows(spark, folder)))


@query
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(_scored_counts(spark, folder), LABEL, n="n")


@query
def tree_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored_counts(spark, folder)
    return _rounded(metrics.accuracy(scored, LABEL, n="n"), "accuracy")


# Encoding, scaling, regression


@query
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    flights = testtables.flights(spark, folder).select(*models.ENCODED)
    codes = rank.dense_codes(flights, models.ENCODED)
    return rank.encode(flights, codes, {name: f"{name}_code" for name in models.ENCODED})


@query
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Dummies of the carrier category, without the alphabetically first category."""
    typed = places.with_carrier_type(
        testtables.flights(spark, folder).select("OP_CARRIER"), testtables.carriers(spark, folder)
    ).where(F.col("CARRIER_TYPE").isNotNull())
    named = typed.select(buckets.carrier_label(F.col("CARRIER_TYPE")).alias("CARRIER_TYPE"))
    dummies = rank.one_hot(named, ["CARRIER_TYPE"])
    all_places = F.sequence(F.lit(0), F.col("dummies.size") - 1)
    bits = F.transform(all_places, lambda i: F.array_contains("dummies.indices", i).cast("int").cast("string"))
    return dummies.select("CARRIER_TYPE", F.array_join(bits, "").alias("dummies"))


@query
def one_hot_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """Carrier, origin and destination as one sparse row, by the places that are 1."""
    flights = testtables.flights(spark, folder).select(*models.ENCODED)
    dummies = rank.one_hot(flights, models.ENCODED)
    hot = F.array_join(F.transform("dummies.indices", lambda i: i.cast("string")), ",")
    return dummies.select(*models.ENCODED, F.col("dummies.size").alias("size"), hot.alias("places"))


@query
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["CRS_DEP_TIME", "DEP_DELAY", "ARR_DELAY"]
    flights = testtables.flights(spark, folder).select(*columns)
    scaled = scale.standardise(flights, scale.fit_scaler(flights, columns), columns)
    return _rounded(scaled, *columns)


def _simple_fit(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.regr_slope("ARR_DELAY", "DEP_DELAY").alias("slope"),
        F.regr_intercept("ARR_DELAY", "DEP_DELAY").alias("intercept"),
    )


def _simple_scores(spark: SparkSession, folder: str) -> DataFrame:
    flights = testtables.flights(spark, folder).select("DEP_DELAY", "ARR_DELAY")
    flights = flights.where(F.col("DEP_DELAY").isNotNull() & F.col("ARR_DELAY").isNotNull())
    fit = _simple_fit(flights).first()
    predicted = models.linear(["DEP_DELAY"], fit["intercept"], [fit["slope"]])
    return flights.select(F.col("ARR_DELAY").alias("label"), predicted.alias("prediction"))


@query
def linreg_simple(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_simple_fit(testtables.flights(spark, folder)), "slope", "intercept")


@query
def pred_actual(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_simple_scores(spark, folder), "prediction")


@query
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    measured = metrics.regression_metrics(_simple_scores(spark, folder), "label")
    return _rounded(measured, "mae", "mse", "rmse", "r2")


# Models: the splits, matrices, least squares and the shallow tree are determined; of the others the
# results depend on the optimiser, so they have no SQL counterpart


def _regression_flights(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned flights, what the regression models take of them. Stored: codes, training and test rows each read it."""
    cleaned = cleaning.cleaned_flights(testtables.flights(spark, folder))
    return stored(cleaned.select(*models.REGRESSION_FEATURES, models.REGRESSION_LABEL))


def _regression_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return models.split(models.regression_rows(_regression_flights(spark, folder)), 0.25, 5)


def _measured(scored: DataFrame) -> DataFrame:
    return metrics.regression_metrics(scored, models.REGRESSION_LABEL)


@query
def regression_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded features and label of the regression models, with the side of the split."""
    train, test = _regression_split(spark, folder)
    return train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test")))


@query
def linear_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of least squares on the test rows: the predictions are determined."""
    train, test = _regression_split(spark, folder)
    model = leastsquares.fit(stored(train), models.REGRESSION_FEATURES, models.REGRESSION_LABEL)
    return _rounded(_measured(model.transform(test)), "mae", "mse", "rmse", "r2")


@query
def tree_regression(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _regression_split(spark, folder)
    rules = regtree.TreeRules(max_depth=8)
    tree_ = regtree.fit(stored(train), models.REGRESSION_FEATURES, models.REGRESSION_LABEL, rules)
    return _measured(tree_.transform(test))


def _shallow_tree(spark: SparkSession, folder: str) -> tuple[regtree.RegressionTree, DataFrame]:
    dated = explore.month_and_day(testtables.flights(spark, folder, calendar=True))
    coded = models.encode_all(dated, rank.dense_codes(dated, models.ENCODED), models.ENCODED)
    rows = checkpointed(models.matrix(coded, models.REQUEST_FEATURES, models.REQUEST_LABEL))
    return regtree.fit(rows, models.REQUEST_FEATURES, models.REQUEST_LABEL, regtree.TreeRules(max_depth=3)), rows


@query
def regression_tree_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """A tree of three levels over the features of a request."""
    nodes = _shallow_tree(spark, folder)[0].nodes
    feature = F.get(F.array(*map(F.lit, models.REQUEST_FEATURES)), F.col("feature")).alias("feature")
    return _rounded(nodes.select("node_id", "level", "n", "prediction", feature, "threshold"), "prediction")


@query
def regression_tree_score(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of that tree over all its rows."""
    tree_, rows = _shallow_tree(spark, folder)
    measured = metrics.regression_metrics(tree_.transform(rows), models.REQUEST_LABEL)
    return _rounded(measured, "mae", "mse", "rmse", "r2")


@query
def boosted_regression(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _regression_split(spark, folder)
    model = models.fit_boosted(train, models.REGRESSION_FEATURES, models.REGRESSION_LABEL)
    return _measured(model.transform(test))


@query
def logistic_classes(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = _regression_flights(spark, folder)
    codes = checkpointed(rank.dense_codes(cleaned, models.ENCODED))
    train, test = models.split(models.regression_rows(cleaned, codes), 0.25, 5)
    train, test = (models.class_rows(side, models.REGRESSION_LABEL) for side in (train, test))
    numbers = [name for name in models.REGRESSION_FEATURES if name not in models.ENCODED]
    model = models.fit_logistic_sparse(train, codes, models.ENCODED, numbers, "label")
    return metrics.confusion_matrix(model.transform(test), "label")


def _network_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    # Stored: codes, training and test rows each read it.
    table = stored(features.network_table(*_dimensions(spark, folder), keep_status=True))
    return models.split(models.network_rows(table), 0.3, 0)


@query
def network_folds(spark: SparkSession, folder: str) -> DataFrame:
    """Rows to train on, to validate with while training, and to test on."""
    train, test = _network_split(spark, folder)
    sides = network.folds(train, models.NETWORK_FEATURES, "label", network.VALIDATION_SHARE, network.SEED)
    named = sides.select(F.when(F.col("held"), "validation").otherwise("train").alias("fold"))
    return named.union(test.select(F.lit("test"))).groupBy("fold").agg(F.count("*").alias("n"))


@query
def network_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded features and class of the network, rows counted."""
    train, test = _network_split(spark, folder)
    rows = train.union(test)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def _network(spark: SparkSession, folder: str) -> tuple[network.NetworkModel, DataFrame]:
    train, test = _network_split(spark, folder)
    return network.fit_network(stored(train), models.NETWORK_FEATURES, "label"), test


@query
def network_classes(spark: SparkSession, folder: str) -> DataFrame:
    model, test = _network(spark, folder)
    return metrics.confusion_matrix(model.transform(test), "label")


@query
def network_history(spark: SparkSession, folder: str) -> DataFrame:
    """Loss and accuracy of both sides after each epoch."""
    return _network(spark, folder)[0].history_table(spark)


def _dated(spark: SparkSession, folder: str) -> DataFrame:
    dated = explore.month_and_day(testtables.flights(spark, folder, calendar=True))
    return dated.select(*models.REQUEST_FEATURES, models.REQUEST_LABEL)


@query
def score_requests(spark: SparkSession, folder: str) -> DataFrame:
    # Stored: codes, training rows, test rows and what is scored are each read from it.
    dated = stored(_dated(spark, folder))
    return requests.fit_requests(dated).transform(dated.select(*models.REQUEST_FEATURES))


@query
def request_split(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that the scorer of requests learns from and is measured on, and their delays."""
    train, test = requests.split_requests(_dated(spark, folder))
    sides = train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test")))
    return sides.groupBy("split").agg(F.count("*").alias("n"), F.sum(models.REQUEST_LABEL).alias("delay"))


@query
def request_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of the scorer on the rows kept from its training."""
    errors = requests.fit_requests(stored(_dated(spark, folder))).errors
    return spark.createDataFrame([tuple(errors.values())], ", ".join(f"{name} double" for name in errors))
