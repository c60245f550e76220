"""Features, forest and scoring with Spark ML."""

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.functions import scoring
from txnrisk.operators import curves, growing, medians
from txnrisk.schemas import CATEGORICAL_FEATURES, CLASSES, LABEL, NUMERIC_FEATURES

# The forest's settings.
TREES = 50
DEPTH = 8
SEED = 42
# Ours: distinct values that a category may have; training rows of one partition, of which the forest
# keeps each as objects of 1.5 kB.
MOST_VALUES = 10_000
PART_ROWS = 100_000
# Ours: training rows up to which Spark ML's forest is fitted, which keeps all of them; above, it is grown
# from histograms.
KEPT_ROWS = 1_000_000


def _suffixed(names: list[str], suffix: str) -> list[str]:
    return [f"{name}_{suffix}" for name in names]


def category_coder(hashed: dict[str, int]) -> SQLTransformer:
    """Categories with too many values for a dictionary as one of so many codes, by hash; null stays null."""
    parts = [
        f"if({name} IS NULL, NULL, concat('h', pmod(xxhash64({name}), {width}L))) AS {name}_code"
        for name, width in hashed.items()
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def category_indexer(hashed: dict[str, int] | None = None) -> StringIndexer:
    """Number the values of each category by frequency, ties by name; null and new ones last."""
    return StringIndexer(
        inputCols=[f"{name}_code" if name in (hashed or {}) else name for name in CATEGORICAL_FEATURES],
        outputCols=_suffixed(CATEGORICAL_FEATURES, "index"),
        handleInvalid="keep",
    )


def gap_filler(values: dict[str, float]) -> SQLTransformer:
    """Numeric inputs with given values in place of null and NaN."""
    parts = [
        f"coalesce(nanvl(CAST({name} AS DOUBLE), NULL), CAST('{value!r}' AS DOUBLE)) AS {name}_filled"
        for name, value in values.items()
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def feature_stages(middle: dict[str, float] | None = None, hashed: dict[str, int] | None = None) -> list:
    """Index and one-hot encode categories, fill numeric gaps, assemble, scale by deviation.

    Categories in ``hashed`` have codes by hash, so many as it says, in place of values.

    A category not seen in training becomes all zeros, a missing number the
    training median: one of ``middle`` or, without these, an approximate one.
    """
    imputer = Imputer(
        strategy="median", inputCols=NUMERIC_FEATURES, outputCols=_suffixed(NUMERIC_FEATURES, "filled")
    )
    hot, filled = _suffixed(CATEGORICAL_FEATURES, "hot"), _suffixed(NUMERIC_FEATURES, "filled")
    return [
        *([category_coder(hashed)] if hashed else []),
        category_indexer(hashed),
        OneHotEncoder(inputCols=_suffixed(CATEGORICAL_FEATURES, "index"), outputCols=hot),
        gap_filler(middle) if middle else imputer,
        VectorAssembler(
            inputCols=hot + filled, outputCol="unscaled_features", handleInvalid="keep"
        ),
        StandardScaler(
            inputCol="unscaled_features", outputCol="features", withStd=True, withMean=False
        ),
    ]


def forest() -> RandomForestClassifier:
    """The forest. Each row's tree nodes are cached between levels: same model, a third faster."""
    return RandomForestClassifier(
        labelCol=LABEL,
        featuresCol="features",
        numTrees=TREES,
        maxDepth=DEPTH,
        seed=SEED,
        cacheNodeIds=True,
    )


def feature_frame(df: DataFrame) -> DataFrame:
    """The nine model inputs of the labelled rows and the label as an integer."""
    known = df.filter(F.col(LABEL).isNotNull())
    return known.select(*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, F.col(LABEL).cast("int"))


def check_inputs(
    inputs: DataFrame, most_values: int = MOST_VALUES, hash_width: int | None = None
) -> list[str]:
    """Raise an error that names what a forest cannot be fitted on.

    Labels have to be the two classes, and both have to occur. Every value of a
    category becomes an input and is kept on the driver, so a category with more
    than ``most_values`` values, by an estimate, is refused and never cut; with a
    ``hash_width`` the result names it, to be coded by hash.
    """
    estimates = [F.approx_count_distinct(c).alias(c) for c in CATEGORICAL_FEATURES]
    label = F.col(LABEL)
    counted = inputs.agg(
        *[F.count_if(label == c).alias(f"class_{c}") for c in CLASSES],
        F.count_if(~label.isin(*CLASSES)).alias("odd"),
        *[F.count(c).alias(c) for c in NUMERIC_FEATURES],
        *estimates,
    ).first()
    if counted["odd"]:
        raise ValueError(f"{counted['odd']} labels are neither of {CLASSES}")
    for c in CLASSES:
        if not counted[f"class_{c}"]:
            raise ValueError(f"no rows labelled {c} with an amount to train on")
    for name in [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]:
        if not counted[name]:
            raise ValueError(f"{name} is null in every row to train on")
    wide = [name for name in CATEGORICAL_FEATURES if counted[name] > most_values]
    for name in wide:
        if not hash_width:
            raise ValueError(f"{name} has about {counted[name]} values; {most_values} are allowed")
    return wide


def in_parts(inputs: DataFrame, most_rows: int | None = None) -> DataFrame:
    """The rows in partitions of about ``most_rows`` (``PART_ROWS``) at most; as they are where none is larger.

    The forest keeps the partitions between its levels, with each row's weights and
    nodes in all trees: many times the bytes that a scan reads. Rows are dealt out
    one by one, so that no value makes a partition large, and ordered there.
    """
    sizes = inputs.groupBy(F.spark_partition_id()).count()
    found = sizes.agg(F.max("count").alias("largest"), F.sum("count").alias("rows")).first()
    most_rows = most_rows or PART_ROWS
    if (found["largest"] or 0) <= most_rows:
        return inputs
    return inputs.repartition(-(-found["rows"] // most_rows)).sortWithinPartitions(*inputs.columns)


def fit(
    train: DataFrame, cache: bool = True, hash_width: int | None = None, most_values: int = MOST_VALUES
) -> PipelineModel:
    """Fit features and forest on the labelled rows that have an amount.

    With ``hash_width``, a category of more than ``most_values`` values gets that
    many codes by hash; without, it is an error.

    The inputs are read several times, so they are kept on the executors
    (memory, then disk) for the time of the fit. A lost executor's part is
    computed again from the table. Up to ``KEPT_ROWS`` the forest is Spark ML's;
    above, it is grown by ``growing``, and the model is of the same kind.
    """
    inputs = feature_frame(train).filter(F.col("amount").isNotNull())
    rows = inputs.count()
    if rows <= KEPT_ROWS:
        inputs = in_parts(inputs)
    if not cache:
        return _fitted(inputs, hash_width, most_values, rows)
    inputs = inputs.persist()
    try:
        return _fitted(inputs, hash_width, most_values, rows)
    finally:
        inputs.unpersist()


def _fitted(inputs: DataFrame, hash_width: int | None, most_values: int, rows: int) -> PipelineModel:
    wide = check_inputs(inputs, most_values, hash_width)
    hashed = {name: hash_width for name in wide}
    middle = {name: median for name, (_, median) in medians.medians(inputs, NUMERIC_FEATURES).items()}
    stages = feature_stages(middle, hashed)
    if rows <= KEPT_ROWS:
        return Pipeline(stages=[*stages, forest()]).fit(inputs)
    features = Pipeline(stages=stages).fit(inputs)
    return PipelineModel([*features.stages, _grown(features, inputs, rows)])


def _grown(features: PipelineModel, inputs: DataFrame, rows: int) -> RandomForestClassificationModel:
    """The forest over what the fitted features make of the inputs, from their indices and filled numbers."""
    encoder = next(s for s in features.stages if isinstance(s, OneHotEncoderModel))
    scaler = next(s for s in features.stages if isinstance(s, StandardScalerModel))
    scales = [1 / deviation if deviation else 0.0 for deviation in scaler.std]
    indices, filled = _suffixed(CATEGORICAL_FEATURES, "index"), _suffixed(NUMERIC_FEATURES, "filled")
    # The last size of each category stands for what is unknown and has no place.
    places = growing.Inputs(indices, [size - 1 for size in encoder.categorySizes], filled, np.array(scales))
    coded = features.transform(inputs).select(*indices, *filled, LABEL)
    return growing.grow(coded, LABEL, places, forest(), rows)


def score(model: PipelineModel, df: DataFrame, threshold: float = scoring.HIGH_RISK) -> DataFrame:
    """Add fraud_probability and prediction; the model's own columns are dropped.

    The prediction follows the threshold, so a probability of exactly 0.5 is 1.0.
    Exploding a one-element array keeps filters on the probability above it.
    Pushed below, they would run the forest once per mention and once more for
    the rows that pass.
    """
    once = F.explode(F.array(scoring.fraud_probability())).alias("fraud_probability")
    return (
        model.transform(df)
        .select(*df.columns, once)
        .withColumn("prediction", scoring.predicted(threshold=threshold))
    )


def evaluate(totals: DataFrame, threshold: float = scoring.HIGH_RISK) -> DataFrame:
    """One row: roc_auc, average_precision, pr_auc, accuracy, test_rows, alerts.

    ``totals`` are ``curves.running_totals`` of the test rows; all is one
    aggregation over them.
    """
    flagged, rows = F.col("score") >= threshold, F.col("pos") + F.col("neg")
    right = F.sum(F.when(flagged, F.col("pos")).otherwise(F.col("neg")))
    return totals.agg(
        *curves.area_columns(),
        F.try_divide(right, F.sum(rows)).alias("accuracy"),
        F.sum(rows).alias("test_rows"),
        F.sum(F.when(flagged, rows).otherwise(0)).alias("alerts"),
    )
