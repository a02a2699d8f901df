"""Gradient-boosted trees on MLlib: training, cross-validation, importance and scores."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions.columns import risk_tier
from ..operators.timeline import along
from ..sources.staging import stage
from .metrics import average_precision, best_threshold, pr_curve, roc_auc
from .split import TARGET, stratified_folds


@dataclass(frozen=True)
class ChurnConfig:
    """Defaults are fixed values of the churn model."""

    trees: int = 500
    depth: int = 6
    step: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 5
    positive_weight: float = 3.0
    folds: int = 5
    seed: int = 42
    # Rounds without gain on the validation part before boosting ends; the best round is kept.
    patience: int = 50
    # Without patience: boosting ends when the validation error falls by less than this share of itself.
    tolerance: float = 0.0001


def kept_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round (from 0) of least loss before ``patience`` rounds pass without gain, and whether they did."""
    best = 0
    for n, loss in enumerate(losses):
        if loss < losses[best]:
            best = n
        elif n - best >= patience:
            return best, True
    return best, False


def truncated(booster: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees."""
    context, java = SparkSession.active().sparkContext, booster._java_obj
    jvm, new_array = context._jvm, context._gateway.new_array
    trees = new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = new_array(jvm.double, rounds)
    for n, (tree, weight) in enumerate(zip(java.trees()[:rounds], java.treeWeights()[:rounds], strict=True)):
        trees[n], weights[n] = tree, weight
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel
    return GBTClassificationModel(made(java.uid(), trees, weights, java.numFeatures(), java.numClasses()))


def boosted(
    booster: GBTClassifier, learn: DataFrame, check: DataFrame, config: ChurnConfig
) -> tuple[GBTClassificationModel, list[float]]:
    """Boosting with patience: the model cut to its best round, and the loss on ``check`` round by round.

    MLlib neither waits nor goes on from a fitted model, but equal seeds give equal first trees. So it
    fits twice the patience first, and twice as many rounds again while the loss may still fall: in all at
    most about twice the rounds a patient learner would make.
    """
    rounds = min(config.trees, 2 * config.patience)
    while True:
        fitted = booster.setMaxIter(rounds).fit(learn)
        losses = list(fitted.evaluateEachIteration(check))
        best, stopped = kept_round(losses, config.patience)
        if stopped or rounds == config.trees:
            return truncated(fitted, best + 1), losses
        rounds = min(config.trees, 2 * rounds)


def train(
    df: DataFrame,
    columns: Sequence[str],
    config: ChurnConfig = ChurnConfig(),
    target: str = TARGET,
    validation: str | None = None,
) -> PipelineModel:
    """Fit the classifier; with a validation flag, boosting stops when that part stops improving."""
    return train_with_curve(df, columns, config, target, validation)[0]


def train_with_curve(
    df: DataFrame,
    columns: Sequence[str],
    config: ChurnConfig = ChurnConfig(),
    target: str = TARGET,
    validation: str | None = None,
) -> tuple[PipelineModel, list[float]]:
    """``train``, and the validation loss of every round tried (none without validation or patience)."""
    weighted = df.withColumn(
        "__weight", F.when(F.col(target) == 1, config.positive_weight).otherwise(1.0)
    )
    booster = GBTClassifier(
        labelCol=target,
        featuresCol="features",
        weightCol="__weight",
        maxIter=config.trees,
        maxDepth=config.depth,
        stepSize=config.step,
        subsamplingRate=config.row_share,
        featureSubsetStrategy=str(config.column_share),
        minInstancesPerNode=config.min_rows,
        seed=config.seed,
    )
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    if validation and config.patience:
        rows = assembler.transform(weighted).select(target, "__weight", "features", validation)
        rows = stage(rows, "training")  # read again by every fit
        check = rows.filter(validation)
        if not check.isEmpty():
            model, losses = boosted(booster, rows.filter(~F.col(validation)), check, config)
            return PipelineModel([assembler, model]), losses
    elif validation:
        booster = booster.setValidationIndicatorCol(validation).setParams(validationTol=config.tolerance)
    return Pipeline(stages=[assembler, booster]).fit(weighted), []


def probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def score(model: PipelineModel, df: DataFrame, as_of: Column) -> DataFrame:
    """Churn probability, tier and date for every row."""
    p = F.round(probability(), 4)
    return model.transform(df).withColumns(
        {"score": p, "risk_tier": risk_tier(p), "as_of_date": as_of}
    ).drop("features", "rawPrediction", "probability", "prediction")


def cross_validate(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    config: ChurnConfig = ChurnConfig(),
    target: str = TARGET,
    at_once: int | None = None,
) -> DataFrame:
    """ROC-AUC per fold; one training run per fold, each of them distributed, ``at_once`` of them together.

    The folds are numbered and written once, and every run reads them from there. Runs are submitted from threads
    of their own, each in its scheduler pool (which counts where the session schedules fairly), so that the small
    jobs of one tree fill what the others leave idle. The fold after the held-out one tells when boosting
    stops, by tolerance; with two folds there is none to spare.
    """
    spark = df.sparkSession
    dealt = stage(stratified_folds(df.select(*dict.fromkeys([*keys, target, *columns])), target, keys, config.folds), "folds")
    impatient = replace(config, patience=0)

    def rate(k: int) -> tuple[int, float | None]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{k}")
        others = dealt.filter(F.col("fold") != k)
        others = others.withColumn("__stop", F.col("fold") == (k + 1) % config.folds)
        model = train(others, columns, impatient, target, "__stop" if config.folds > 2 else None)
        held_out = model.transform(dealt.filter(F.col("fold") == k)).withColumn("p", probability())
        return k, roc_auc(held_out, target, "p").first()["roc_auc"]

    with ThreadPoolExecutor(at_once or config.folds) as pool:
        rated = list(pool.map(inheritable_thread_target(spark)(rate), range(config.folds)))
    return spark.createDataFrame(rated, "fold int, roc_auc double")


def report(model: PipelineModel, held_out: DataFrame, target: str = TARGET) -> DataFrame:
    """One row over scored held-out rows: ROC-AUC, average precision and the best threshold."""
    scored = model.transform(held_out).select(target, F.round(probability(), 4).alias("score"))
    curve = pr_curve(scored, target, "score")
    rated = [roc_auc(scored, target, "score"), average_precision(curve), best_threshold(curve)]
    one, *more = [df.withColumn("__row", F.lit(1)) for df in rated]  # one row each
    for df in more:
        one = one.join(df, "__row")
    return one.select(
        "roc_auc", "positives", "negatives", "average_precision", "threshold", "f1", "precision", "recall"
    )


def permutation_importance(
    model: PipelineModel, df: DataFrame, columns: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Mean change of the score when one feature takes the value of another row.

    Each row borrows from its neighbour in the order of a hash of the keys: one ordered pass, then
    one scoring pass over rows x features. All vector work is done by built-in array functions.
    """
    assembler, booster = model.stages
    base = booster.transform(assembler.transform(df)).select(
        *keys, vector_to_array("features").alias("own"), probability().alias("p")
    )
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    slot = F.conv(F.substring("__h", 1, 3), 16, 10).cast("long")
    paired = along(
        base.withColumn("__h", digest), [], ["__h", *keys], slot, previous={"donor": "own"}
    ).withColumn("donor", F.coalesce("donor", "own"))
    swapped = paired.select(
        "p", F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("j", "feature"), "own", "donor"
    ).withColumn(
        "features",
        array_to_vector(
            F.transform("own", lambda x, i: F.when(i == F.col("j"), F.get("donor", i)).otherwise(x))
        ),
    )
    moved = booster.transform(swapped.select("feature", "p", "features").withColumnRenamed("p", "__p"))
    change = F.abs(probability() - F.col("__p"))
    return moved.groupBy("feature").agg(F.avg(change).alias("importance"))


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most important features: a report of fixed length."""
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)
