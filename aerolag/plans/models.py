"""Regression and classification of delays with MLlib.

Labels are encoded through code tables (:mod:`aerolag.operators.rank`), so no
vocabulary passes through the driver, and features are standardised with the
mean and deviation of the training rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.functions import buckets
from aerolag.operators import subtrees
from aerolag.operators.rank import dense_codes, encode, vocabulary_sizes
from aerolag.plans.boosting import boost
from aerolag.plans.cleaning import KEPT
from aerolag.session import checkpointed, stored

# The regression label, and the kept columns that are not features.
REGRESSION_LABEL = "DEP_DELAY"
NOT_FEATURES = ["DEP_DELAY", "CRS_DEP_TIME", "OP_CARRIER_FL_NUM", "ARR_TIME"]
REGRESSION_FEATURES = [name for name in KEPT if name not in NOT_FEATURES]
ENCODED = ["OP_CARRIER", "ORIGIN", "DEST"]

# Features of a scoring request, and its label.
REQUEST_FEATURES = ["MONTH", "DAY", "OP_CARRIER", "ORIGIN", "DEST"]
REQUEST_LABEL = "ARR_DELAY"

# Features and hidden layers of the network, and its classes.
NETWORK_FEATURES = [
    "OP_CARRIER",
    "OP_CARRIER_FL_NUM",
    "CRS_DEP_TIME",
    "DEP_DELAY",
    "CRS_ARR_TIME",
    "DIVERTED",
    "CANCELLED",
    "ORIG_AREA",
    "DEST_AREA",
    "ORIG_WEATHER",
    "DEST_WEATHER",
    "MONTH",
]
NETWORK_ENCODED = ["OP_CARRIER", "ORIG_AREA", "DEST_AREA", "ORIG_WEATHER", "DEST_WEATHER"]
HIDDEN_LAYERS = [32, 64, 128, 64, 32]
CLASSES = 9

SEED = 2
# MLlib's own limit of depth, and the rows a leaf of a regression tree holds at least.
MAX_DEPTH = 30
MIN_LEAF = 20
# Rows up to which MLlib grows a deep tree whole: its bins are then those of all rows, not of a sample.
WHOLE_ROWS = 65_536
# Levels of the top of a larger tree, and by how many it is deepened while a leaf has over GROUP_ROWS rows.
TOP_DEPTH = 10
DEEPER = 3
GROUP_ROWS = 4_000_000
LEAF = "_leaf_of_top"


def encode_all(df: DataFrame, codes: DataFrame, names: list[str]) -> DataFrame:
    """The named columns replaced by their codes; unseen values become -1."""
    encoded = encode(df, codes, {name: f"{name}_code" for name in names}).drop(*names)
    return encoded.withColumnsRenamed({f"{name}_code": name for name in names})


def matrix(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Features and label as doubles; missing cells count 0, as in the cleaned table."""
    return df.select(
        *[F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)).alias(name) for name in [*features, label]]
    )


def split(df: DataFrame, test_share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the row, whatever its partition; equal rows stay together."""
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *cells)), 1, 8)
    in_test = F.conv(digits, 16, 10).cast("bigint") % 100 < round(100 * test_share)
    return df.where(~in_test), df.where(in_test)


def _fit(train: DataFrame, features: list[str], estimator, is_stored: bool = False) -> PipelineModel:
    """Assemble, standardise, train. The rows are stored once, unless they are already.

    They are not cached: estimators that pass over them often cache what they make of them.
    """
    assembler = VectorAssembler(inputCols=features, outputCol="raw_features")
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="raw_features", outputCol="features")
    return Pipeline(stages=[assembler, scaler, estimator]).fit(train if is_stored else stored(train))


def fit_linear(train: DataFrame, features: list[str], label: str) -> PipelineModel:
    return _fit(train, features, LinearRegression(labelCol=label, solver="normal"))


def fit_tree_regressor(
    train: DataFrame,
    features: list[str],
    label: str,
    max_depth: int = MAX_DEPTH,
    min_rows: int = MIN_LEAF,
    leaf: str = "",
    is_stored: bool = False,
) -> PipelineModel:
    """Codes enter as plain numbers, so bins do not grow with the vocabulary. Leaves hold ``min_rows``.

    ``leaf`` may name a column for the number of the leaf that a row reaches.
    """
    estimator = DecisionTreeRegressor(
        labelCol=label, maxDepth=max_depth, maxBins=256, minInstancesPerNode=min_rows, seed=SEED, leafCol=leaf
    )
    return _fit(train, features, estimator, is_stored)


def fit_deep_tree(
    train: DataFrame,
    features: list[str],
    label: str,
    max_depth: int = MAX_DEPTH,
    min_rows: int = MIN_LEAF,
    whole_rows: int = WHOLE_ROWS,
    top_depth: int = TOP_DEPTH,
) -> PipelineModel:
    """The same tree, its top by MLlib and the levels below it in tasks by leaf (:mod:`aerolag.operators.subtrees`).

    MLlib sends dense sums of every node from every partition, so it would not finish all levels of many rows;
    a table of up to ``whole_rows`` it grows whole. ``train`` has plain numbers without nulls.
    """
    rows = stored(train)
    if max_depth <= top_depth or rows.count() <= whole_rows:
        return fit_tree_regressor(rows, features, label, max_depth, min_rows, is_stored=True)
    while True:
        top = fit_tree_regressor(rows, features, label, top_depth, min_rows, LEAF, is_stored=True)
        placed = stored(top.transform(rows).select(*features, label, LEAF))
        largest = placed.groupBy(LEAF).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        # A group is grown in one task, so a leaf that is too large for that gets a deeper top.
        if largest <= GROUP_ROWS or top_depth + DEEPER >= max_depth:
            break
        top_depth += DEEPER
    grown = subtrees.grow(placed, features, label, LEAF, max_depth - top_depth, min_rows)
    below = subtrees.Subtrees(inputCols=features, leaf=LEAF).with_subtrees(grown)
    return PipelineModel([*top.stages, below])


def fit_logistic(train: DataFrame, features: list[str], label: str, max_iter: int = 50) -> PipelineModel:
    return _fit(train, features, LogisticRegression(labelCol=label, maxIter=max_iter))


def fit_logistic_sparse(
    train: DataFrame, codes: DataFrame, categories: list[str], numbers: list[str], label: str, max_iter: int = 50
) -> PipelineModel:
    """Logistic regression on one-hot categories, first value dropped, and standardised numbers.

    ``train`` has codes of ``codes`` in the columns of ``categories``, -1 for unseen values. Rows are
    sparse vectors: their size does not depend on the vocabularies.
    """
    sizes = vocabulary_sizes(codes)
    used = [name for name in categories if sizes.get(name, 0) > 1]
    # The encoder drops the last place; the first value and unseen ones are sent there.
    shifted = ", ".join(
        f"CASE WHEN `{name}` > 0 THEN `{name}` - 1 ELSE {sizes[name] - 1} END AS `{name}_place`" for name in used
    )
    stages = [SQLTransformer(statement=f"SELECT *, {shifted} FROM __THIS__")] if used else []
    for name in used:
        # Fitted on the vocabulary, not on the rows at hand.
        places = codes.where(F.col("name") == name).select(F.col("code").cast("double").alias(f"{name}_place"))
        encoder = OneHotEncoder(inputCols=[f"{name}_place"], outputCols=[f"{name}_dummies"], dropLast=True)
        stages.append(encoder.fit(places))
    stages += [
        VectorAssembler(inputCols=numbers, outputCol="raw_numbers"),
        StandardScaler(withMean=True, withStd=True, inputCol="raw_numbers", outputCol="scaled_numbers"),
        VectorAssembler(inputCols=[*(f"{name}_dummies" for name in used), "scaled_numbers"], outputCol="features"),
        LogisticRegression(labelCol=label, maxIter=max_iter),
    ]
    # Every pass sends a slope as long as all vocabularies from each partition: no more of them than
    # run at once. The estimator caches the vectors that it makes, so the rows are not cached beside them.
    cores = train.sparkSession.sparkContext.defaultParallelism
    return Pipeline(stages=stages).fit(stored(train).coalesce(cores))


def fit_network(
    train: DataFrame, features: list[str], label: str, max_iter: int = 50
) -> PipelineModel:
    """Softmax network; hidden units are sigmoid and training is L-BFGS."""
    estimator = MultilayerPerceptronClassifier(
        labelCol=label,
        layers=[len(features), *HIDDEN_LAYERS, CLASSES],
        maxIter=max_iter,
        blockSize=256,
        seed=SEED,
    )
    return _fit(train, features, estimator)


# A member of a boosted model as a row: at most as many as rounds.
MEMBER = "number int, features array<string>, intercept double, coefficients array<double>, weight double"


@dataclass
class BoostedModel:
    """Linear models of one AdaBoost.R2 run, with their confidence weights."""

    features: list[str]
    intercepts: list[float]
    coefficients: list[list[float]]
    weights: list[float]

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the members as a table, one row each."""
        members = zip(self.intercepts, self.coefficients, self.weights)
        rows = [(i, self.features, *member) for i, member in enumerate(members)]
        spark.createDataFrame(rows, MEMBER).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        rows = sorted(spark.read.schema(MEMBER).parquet(path).collect())
        return cls(
            list(rows[0]["features"]) if rows else [],
            [row["intercept"] for row in rows],
            [list(row["coefficients"]) for row in rows],
            [row["weight"] for row in rows],
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """``prediction``: the median of the members' predictions by weight."""
        members = F.array(
            *[
                F.struct(
                    linear(self.features, intercept, coefficients).alias("value"),
                    F.lit(weight).alias("weight"),
                )
                for intercept, coefficients, weight in zip(
                    self.intercepts, self.coefficients, self.weights
                )
            ]
        )
        half = sum(self.weights) / 2

        def step(state: Column, member: Column) -> Column:
            upto = state["upto"] + member["weight"]
            # The first member at which the running weight reaches one half.
            reached = F.coalesce(state["value"], F.when(upto >= half, member["value"]))
            return F.struct(upto.alias("upto"), reached.alias("value"))

        start = F.struct(F.lit(0.0).alias("upto"), F.lit(None).cast("double").alias("value"))
        median = F.aggregate(F.array_sort(members), start, step, lambda state: state["value"])
        return df.withColumn("prediction", median)


def linear(features: list[str], intercept: float, coefficients: list[float]) -> Column:
    total = F.lit(float(intercept))
    for name, coefficient in zip(features, coefficients):
        total = total + F.col(name) * float(coefficient)
    return total


def fit_boosted(
    train: DataFrame, features: list[str], label: str, rounds: int = 50
) -> BoostedModel:
    """AdaBoost.R2 over least squares, as in :mod:`aerolag.plans.boosting`."""
    fits, weights = boost(train, features, label, rounds)
    return BoostedModel(features, [fit.intercept for fit in fits], [fit.coefficients for fit in fits], weights)


def regression_rows(cleaned: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Feature matrix and label of the regression models, from cleaned flights."""
    # Checkpointed: every pass over the rows reads them.
    codes = checkpointed(dense_codes(cleaned, ENCODED)) if codes is None else codes
    encoded = encode_all(cleaned, codes, ENCODED)
    return matrix(encoded, REGRESSION_FEATURES, REGRESSION_LABEL)


def class_rows(rows: DataFrame, label: str) -> DataFrame:
    """The label as delay class counted from 0, for classifiers."""
    code = buckets.delay_code(F.col(label)) - 1
    return rows.withColumn("label", code.cast("double"))


def network_rows(table: DataFrame) -> DataFrame:
    """Feature matrix and class of the network, from its table with flight status."""
    dated = table.withColumn("MONTH", F.month("FL_DATE"))
    encoded = encode_all(dated, dense_codes(dated, NETWORK_ENCODED), NETWORK_ENCODED)
    return class_rows(matrix(encoded, NETWORK_FEATURES, "ARR_DELAY"), "ARR_DELAY").drop("ARR_DELAY")


def fit_requests(flights: DataFrame, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, PipelineModel]:
    """Code table and tree for scoring requests, from dated flights."""
    codes = dense_codes(flights, ENCODED)
    rows = matrix(encode_all(flights, codes, ENCODED), REQUEST_FEATURES, REQUEST_LABEL)
    return codes, fit_tree_regressor(rows, REQUEST_FEATURES, REQUEST_LABEL, max_depth)


def score_requests(
    requests: DataFrame, codes: DataFrame, model: PipelineModel
) -> DataFrame:
    """Requests (month, day, carrier, origin, dest) with the predicted arrival delay."""
    named = requests.withColumns({f"_{name}": F.col(name) for name in ENCODED})
    scored = model.transform(encode_all(named, codes, ENCODED)).drop("raw_features", "features", *ENCODED)
    return scored.withColumnsRenamed({f"_{name}": name for name in ENCODED})
