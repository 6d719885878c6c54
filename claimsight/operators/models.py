"""Claim classifier on Spark ML: vector, training, scoring, selection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsight.functions.codes import risk_tier

# The order of the vector is part of the model's contract.
FEATURES = [
    "amount",
    "claim_count_30d",
    "avg_amount_30d",
    "amount_ratio",
    "hour_of_day",
    "is_weekend",
    "procedure_risk",
    "member_claim_count_90d",
]

# Training settings of the classifier.
TREES = 150
DEPTH = 4
RATE = 0.08
ROW_SHARE = 0.8
SEED = 42

DEFAULT_VERSION = "gbt-v1"


@dataclass
class ClaimModel:
    """Fitted stages with the name of their version."""

    stages: PipelineModel
    version: str = DEFAULT_VERSION


def as_doubles(df: DataFrame) -> DataFrame:
    """The feature columns as doubles (vectors hold nothing else)."""
    return df.withColumns({f: F.col(f).cast("double") for f in FEATURES})


def feature_vector(df: DataFrame) -> DataFrame:
    """Adds ``features``; rows with a missing feature are an error, not dropped."""
    stage = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="error")
    return stage.transform(as_doubles(df))


def classifier(trees: int = TREES, **more) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=trees,
        maxDepth=DEPTH,
        stepSize=RATE,
        subsamplingRate=ROW_SHARE,
        seed=SEED,
        maxMemoryInMB=512,
        cacheNodeIds=True,
        checkpointInterval=10,
        **more,
    )


def train(
    df: DataFrame, trees: int = TREES, version: str = DEFAULT_VERSION, **more
) -> ClaimModel:
    """Boosted trees on the feature columns and ``label``."""
    from claimsight.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fitted = Pipeline(stages=[assembler, classifier(trees, **more)]).fit(as_doubles(df))
    return ClaimModel(fitted, version)


def predict(df: DataFrame, model: ClaimModel) -> DataFrame:
    """Adds ``fraud_probability`` (four decimals), its tier and the model version.

    Runs on batch and stream alike; the claim's own columns keep their types. A claim that
    lacks a feature (it has no time, say) gets 0.
    """
    if "amount" not in df.columns:
        df = df.withColumn("amount", F.col("amount_cents") / 100)
    kept = {f: F.col(f).alias(f"_kept_{f}") for f in FEATURES}
    whole = as_doubles(df.select("*", *kept.values())).fillna(0.0, subset=FEATURES)
    scored = model.stages.transform(whole)
    lacking = F.exists(F.array(*[F.col(f"_kept_{f}").isNull() for f in FEATURES]), lambda x: x)
    probability = F.when(lacking, 0.0).otherwise(F.round(vector_to_array("probability")[1], 4))
    back = {f: F.col(f"_kept_{f}") for f in FEATURES}
    result = scored.withColumns(
        {**back, "fraud_probability": probability, "model_version": F.lit(model.version)}
    )
    names = [*df.columns, "fraud_probability", "model_version"]
    return result.select(*names)


def with_probability_tier(df: DataFrame) -> DataFrame:
    return df.withColumn("model_risk_level", risk_tier(F.col("fraud_probability")))


def save(model: ClaimModel, path: str) -> None:
    model.stages.write().overwrite().save(path)


def load_or_train(
    path: str, data: DataFrame, version: str = DEFAULT_VERSION, **options
) -> ClaimModel:
    """The saved model if there is one, else a new one that is saved."""
    spark = data.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(folder):
        return ClaimModel(PipelineModel.load(path), version)
    model = train(data, version=version, **options)
    save(model, path)
    return model


def evaluate(df: DataFrame, model: ClaimModel, metric: str = "areaUnderROC") -> float:
    scored = model.stages.transform(as_doubles(df))
    return BinaryClassificationEvaluator(labelCol="label", metricName=metric).evaluate(scored)


def search(
    df: DataFrame,
    *,
    depths: tuple[int, ...] = (3, 4, 5),
    rates: tuple[float, ...] = (0.05, 0.08, 0.1),
    trees: int = TREES,
    parallelism: int = 4,
):
    """Parameter search with one validation split; returns model and settings."""
    gbt = classifier(trees)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(
        gbt.stepSize, list(rates)
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    tuner = TrainValidationSplit(
        estimator=gbt,
        estimatorParamMaps=grid.build(),
        evaluator=BinaryClassificationEvaluator(labelCol="label"),
        trainRatio=0.8,
        seed=SEED,
        parallelism=parallelism,
    )
    fitted = tuner.fit(assembler.transform(as_doubles(df)))
    table = [
        {**{p.name: v for p, v in params.items()}, "auc": auc}
        for params, auc in zip(tuner.getEstimatorParamMaps(), fitted.validationMetrics)
    ]
    best = PipelineModel([assembler, fitted.bestModel])
    return ClaimModel(best, "gbt-tuned"), table


def promote(
    champion: ClaimModel, challenger: ClaimModel, held_out: DataFrame, min_gain: float = 0.005
) -> tuple[ClaimModel, float]:
    """The challenger if its area under the curve is better by ``min_gain``."""
    gain = evaluate(held_out, challenger) - evaluate(held_out, champion)
    return (challenger if gain > min_gain else champion), gain
