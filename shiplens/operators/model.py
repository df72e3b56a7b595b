"""Late-delivery model: pipeline, training, evaluation, scoring (ML-1..12, SCH-3, SNK-9).

Spark ML estimators do the work; every stage is row-wise at transform time,
so the same fitted pipeline scores a batch table or a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.functions.numeric import class_probability
from shiplens.operators.clean import impute_constant
from shiplens.operators.features import DELIVERY_ALIASES, LABEL, SELECTED_FEATURES, numeric_and_categorical
from shiplens.operators.ranking import rank_sum
from shiplens.operators.schema import present, quoted
from shiplens.session import remove_path, scan_by_file, stage_table

# Forest settings of the trained model.
NUM_TREES = 100
MAX_DEPTH = 5
MAX_BINS = 32
SEED = 42

# Rows of one task while a forest is fitted: it keeps every row with a number per feature and per tree, uncompressed.
ROWS_PER_TASK = 250_000

# Digits of a probability that count when rows are ranked: sums of the same votes in another order tie.
PROBABILITY_DIGITS = 8

# Columns a prediction row carries when present.
PREDICTION_COLUMNS = [
    "order_id",
    "customer_id",
    "market",
    "order_region",
    "shipping_mode",
    "customer_segment",
    "delivery_days",
    "sales",
]


class CardinalityError(ValueError):
    """A categorical feature has too many distinct values to index."""


def cardinality_check(df: DataFrame, categorical: Sequence[str], max_categories: int) -> dict:
    """Approximate distinct counts of ``categorical`` in one pass; raise above the caller's bound.

    The fitted indexer keeps every label on the driver and the encoder makes
    one slot per label, so a caller can state how many that may be.
    ``approx_count_distinct`` keeps a fixed-size sketch per column and task,
    so the check itself never holds the values.
    """
    categorical = list(categorical)
    if not categorical:
        return {}
    row = df.agg(*[F.approx_count_distinct(quoted(c)).alias(c) for c in categorical]).first()
    counts = {c: int(row[c]) for c in categorical}
    too_many = {c: n for c, n in counts.items() if n > max_categories}
    if too_many:
        raise CardinalityError(f"categorical features above {max_categories} distinct values: {too_many}")
    return counts


class LeakError(ValueError):
    """The label was computed from one of the selected features."""


def leak_check(features: Sequence[str], label_from: str | None, allow_leak: bool = False) -> None:
    """Refuse features the label was derived from, unless ``allow_leak`` (ML-12).

    With a label of ``delivery_days > 5`` a model that sees ``delivery_days``
    scores perfectly and learns nothing useful for scoring new orders.
    """
    if label_from is None or allow_leak:
        return
    leaked = [f for f in features if f == label_from or (label_from in DELIVERY_ALIASES and f in DELIVERY_ALIASES)]
    if leaked:
        raise LeakError(f"label was derived from feature(s) {leaked}; pass allow_leak=True to train anyway")


def build_pipeline(
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str = LABEL,
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = SEED,
) -> Pipeline:
    """Index → one-hot → assemble → scale (no centring) → random forest.

    Multi-column indexer and encoder: one pass each instead of one per column.
    Unseen or null categories are kept and end up as the all-zero vector.
    """
    categorical, numeric = list(categorical), list(numeric)
    stages = []
    if categorical:
        idx = [f"{c}_idx" for c in categorical]
        ohe = [f"{c}_ohe" for c in categorical]
        stages.append(
            StringIndexer(
                inputCols=categorical, outputCols=idx, handleInvalid="keep", stringOrderType="frequencyDesc"
            )
        )
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
    else:
        ohe = []
    stages.append(VectorAssembler(inputCols=ohe + numeric, outputCol="features_unscaled", handleInvalid="error"))
    stages.append(StandardScaler(inputCol="features_unscaled", outputCol="features", withStd=True, withMean=False))
    stages.append(
        RandomForestClassifier(
            labelCol=label,
            featuresCol="features",
            numTrees=num_trees,
            maxDepth=max_depth,
            maxBins=MAX_BINS,
            impurity="gini",
            seed=seed,
        )
    )
    return Pipeline(stages=stages)


@dataclass
class TrainResult:
    model: PipelineModel
    auc: float
    accuracy: float
    n_train: int
    n_test: int


def evaluate(predictions: DataFrame, label: str = LABEL) -> tuple[float, float]:
    """ROC AUC on the probability column and accuracy on the prediction (ML-7)."""
    auc, acc, _ = evaluate_with_count(predictions, label)
    return auc, acc


def evaluate_with_count(predictions: DataFrame, label: str = LABEL) -> tuple[float, float, int]:
    """AUC, accuracy and the number of rows evaluated.

    The scored rows are staged as three columns of Parquet: the exact AUC
    (:func:`ranking.rank_sum`) counts them by score, and count and accuracy are one
    aggregation of the confusion counts.  Nothing of the table's size stays in executor memory.
    """
    kept = predictions.select(label, "prediction", F.round(class_probability("probability"), PROBABILITY_DIGITS).alias("p1"))
    scored, path = stage_table(kept, "evaluation")
    try:
        auc = rank_sum(scored, label, "p1").auc
        counts = confusion_counts(scored, label).collect()  # one row per pair of classes
    finally:
        remove_path(predictions.sparkSession, path)
    n = sum(r["n"] for r in counts)
    right = sum(r["n"] for r in counts if r["label"] == r["prediction"])
    return auc, right / n if n else float("nan"), n


def train_late_model(
    table: DataFrame,
    features: Sequence[str] = SELECTED_FEATURES,
    label: str = LABEL,
    split_col: str = "split",
    label_from: str | None = "delivery_days",
    allow_leak: bool = False,
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = SEED,
    max_categories: int | None = None,
) -> TrainResult:
    """Fit the pipeline on ``split == 'train'`` rows and evaluate on the rest (ML-6).

    ``table`` comes from :func:`features.feature_table` plus
    :func:`features.split_hash`.  The fit reads its input about six times
    (cardinality check, indexer, scaler, forest metadata, split points,
    binning), so the table is written once to Parquet in the shared folder
    and both splits are read from there (:func:`session.stage_table`).  With
    ``max_categories`` a categorical feature beyond it is refused.

    The forest caches each training row as a binned vector and a weight per
    tree (some 700 bytes with 100 trees), while a stored row takes a few dozen.
    So a table of more than ``ROWS_PER_TASK`` rows is read by files of at most
    that many, and no task holds more rows at once.
    """
    feats = present(table, features)
    leak_check(feats, label_from, allow_leak)
    numeric, categorical = numeric_and_categorical(table, feats)
    pipe = build_pipeline(categorical, numeric, label, num_trees, max_depth, seed)
    staged, staged_path = stage_table(table, "model-input", ROWS_PER_TASK)
    try:
        fitted_on = scan_by_file(table.sparkSession, staged_path) if staged.count() > ROWS_PER_TASK else staged
        train = fitted_on.where(F.col(split_col) == "train")
        test = staged.where(F.col(split_col) == "test")
        if max_categories is not None:
            cardinality_check(train, categorical, max_categories)
        model = pipe.fit(train)
        n_train = train.count()
        auc, acc, n_test = evaluate_with_count(model.transform(test), label)
    finally:
        # the fitted model and the metrics do not refer to the staged rows;
        # a failed clean-up must not hide the training result or its error
        try:
            remove_path(table.sparkSession, staged_path)
        except Exception as exc:  # reported, not raised
            import warnings

            warnings.warn(f"could not remove staged table {staged_path}: {exc}", stacklevel=2)
    return TrainResult(model, auc, acc, n_train, n_test)


def fill_inputs(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the model's raw inputs filled as at training: 0 or ``unknown`` for missing values."""
    return impute_constant(df, cols=present(df, required_raw_inputs(model)))


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = PREDICTION_COLUMNS) -> DataFrame:
    """Rows of ``df`` with ``prediction`` and ``prob_class_1`` (ML-9).

    The output is a contract: the columns of ``keep`` that ``df`` has, as they
    were given, then the two results.  Missing input values are filled for
    the model only; a model without a probability fails.
    """
    kept = present(df, keep)
    given = F.struct(*[F.col(quoted(c)) for c in kept], F.lit(0).alias("__row")).alias("__given")
    inputs = fill_inputs(model, df.select("*", given))
    results = [F.col("prediction"), class_probability("probability").alias("prob_class_1")]
    return model.transform(inputs).select(*[F.col(f"__given.{quoted(c)}") for c in kept], *results)


def confusion_counts(scored: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per (label, prediction) pair (ML-8)."""
    return scored.groupBy(F.col(label).alias("label"), F.col("prediction").cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def required_raw_inputs(model: PipelineModel) -> list[str]:
    """Raw input columns the fitted pipeline needs (SCH-3).

    Walks the stages (also nested pipelines) in order, collecting every input
    column that no earlier stage produced.
    """
    produced: set[str] = set()
    needed: list[str] = []

    def walk(stages):
        for st in stages:
            if isinstance(st, PipelineModel):
                walk(st.stages)
                continue
            ins: list[str] = []
            for p in ("inputCol", "inputCols", "featuresCol"):
                if st.hasParam(p) and st.isDefined(st.getParam(p)):
                    v = st.getOrDefault(st.getParam(p))
                    ins += v if isinstance(v, list) else [v]
            for c in ins:
                if c not in produced and c not in needed:
                    needed.append(c)
            for p in ("outputCol", "outputCols", "predictionCol", "probabilityCol", "rawPredictionCol"):
                if st.hasParam(p) and st.isDefined(st.getParam(p)):
                    v = st.getOrDefault(st.getParam(p))
                    produced.update(v if isinstance(v, list) else [v])

    walk(model.stages)
    return needed


def missing_inputs(model: PipelineModel, df: DataFrame) -> list[str]:
    """Required raw inputs absent from ``df`` (warn before scoring an upload)."""
    return [c for c in required_raw_inputs(model) if c not in df.columns]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
