"""Next-best-offer classifiers on Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankspark.operators.features import FLAG_PRODUCTS

LABEL = "next_best_offer"
INPUTS = [
    "age", "income_rank", "tenure_months", "num_products_held", "total_balance", *FLAG_PRODUCTS,
    "txn_count_90d", "avg_txn_amount", "total_spend", "category_variety", "digital_engagement_score",
]
TRAIN_SHARE = 8
SEED = 7
ROWS_PER_TASK = 500_000  # of the rows that models train on, at most


def ml_split(features: DataFrame) -> DataFrame:
    """Mark each customer as train or test by the hash of its id: the same on every run and layout."""
    bucket = F.conv(F.substring(F.md5("customer_id"), 1, 8), 16, 10).cast("bigint") % 10
    return features.withColumn("split", F.when(bucket < TRAIN_SHARE, "train").otherwise("test"))


def candidates() -> dict:
    common = {"featuresCol": "inputs", "labelCol": "label_index"}
    return {
        "decision_tree": DecisionTreeClassifier(maxDepth=10, seed=SEED, **common),
        "random_forest": RandomForestClassifier(numTrees=40, maxDepth=10, seed=SEED, **common),
        "logistic_regression": LogisticRegression(maxIter=30, **common),
        "naive_bayes": NaiveBayes(modelType="gaussian", **common),
    }


@dataclass
class Trained:
    """The fitted pipelines, best first, with their holdout scores."""

    scores: list[tuple[str, float, float]]
    models: dict[str, PipelineModel]

    @property
    def best(self) -> PipelineModel:
        return self.models[self.scores[0][0]]


def ready(features: DataFrame) -> DataFrame:
    """Inputs without NULL: a customer without transactions scores 0."""
    return features.na.fill(0.0, ["digital_engagement_score", "tenure_months"])


def for_training(data: DataFrame, rows: int) -> DataFrame:
    """The rows in as many partitions as there are cores, more only if those would be very large, kept while models train.

    For each level of a tree every partition sends the statistics of all nodes, whatever rows it has, and every
    iteration of a fit is a job: both grow with the partitions, not with the rows.
    """
    tasks = max(data.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return data.repartition(tasks, F.xxhash64("customer_id")).drop("customer_id").persist(StorageLevel.MEMORY_AND_DISK)


def holdout_scores(predicted: DataFrame) -> tuple[float, float]:
    """F1, weighted by the true labels, and accuracy of (prediction, label_index), from one pass.

    The counts come as one row per pair of labels, which the short list of offers bounds.
    """
    counts = {
        (r["label_index"], r["prediction"]): r["n"]
        for r in predicted.groupBy("label_index", "prediction").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    total, f1 = sum(counts.values()), 0.0
    for label in {a for a, _ in counts}:
        true = sum(n for (a, _), n in counts.items() if a == label)
        guessed = sum(n for (_, b), n in counts.items() if b == label)
        f1 += true * 2 * counts.get((label, label), 0) / (true + guessed)
    right = sum(n for (a, b), n in counts.items() if a == b)
    return (f1 / total, right / total) if total else (0.0, 0.0)


def fingerprint(features: DataFrame) -> str:
    """Tells feature tables of unlike content apart, whatever their layout; a model is kept under that of its table."""
    key = F.xxhash64(*(F.col(c) for c in sorted(features.columns)))
    wide = key.cast("decimal(38,0)")
    row = features.agg(F.count(F.lit(1)).alias("n"), F.sum(wide).alias("total"), F.bit_xor(key).alias("bits")).first()
    return f"{row['n']}:{row['total']}:{row['bits']}"


def save(spark: SparkSession, trained: Trained, folder: str) -> None:
    """The leaderboard and the best model below a folder that all executors share."""
    board = spark.createDataFrame(trained.scores, "model string, f1 double, accuracy double")
    board.coalesce(1).write.parquet(f"{folder}/leaderboard")
    trained.best.write().save(f"{folder}/best")


def load(spark: SparkSession, folder: str) -> tuple[DataFrame, PipelineModel]:
    return spark.read.parquet(f"{folder}/leaderboard"), PipelineModel.load(f"{folder}/best")


def score(features: DataFrame, model: PipelineModel) -> DataFrame:
    """The model's offer for every customer."""
    return model.transform(ready(features)).select("customer_id", "segment", "predicted_offer")


def actions(scored: DataFrame) -> DataFrame:
    """Customers per segment and predicted offer: what the bank would act on."""
    return scored.groupBy("segment", "predicted_offer").agg(F.count(F.lit(1)).alias("customers"))


def train(features: DataFrame) -> Trained:
    """Fit every candidate on the train part and rank them on the test part.

    ``features`` should be a stored table, since its rows are counted first.
    Its assembled inputs are kept on memory and disk while the models train; a
    lost executor recomputes its part.
    """
    assembler = VectorAssembler(inputCols=INPUTS, outputCol="inputs")
    data = for_training(
        assembler.transform(ml_split(ready(features))).select("customer_id", "split", "inputs", LABEL), features.count())
    try:
        indexer = StringIndexer(inputCol=LABEL, outputCol="label_index", stringOrderType="alphabetAsc").fit(data)
        namer = IndexToString(inputCol="prediction", outputCol="predicted_offer", labels=indexer.labels)
        indexed = indexer.transform(data)
        train_part, test_part = indexed.filter("split = 'train'"), indexed.filter("split = 'test'")
        models, scores = {}, []
        for name, classifier in candidates().items():
            fitted = classifier.fit(train_part)
            predicted = fitted.transform(test_part).select("prediction", "label_index")
            models[name] = PipelineModel(stages=[assembler, fitted, namer])
            scores.append((name, *holdout_scores(predicted)))
    finally:
        data.unpersist()
    scores.sort(key=lambda s: (-s[1], s[0]))
    return Trained(scores, models)


def ml_leaderboard(features: DataFrame, trained: Trained | None = None) -> DataFrame:
    """(model, f1, accuracy), best first."""
    trained = trained or train(features)
    return features.sparkSession.createDataFrame(trained.scores, "model string, f1 double, accuracy double")


def ml_batch_score(features: DataFrame, trained: Trained | None = None) -> DataFrame:
    """The best model's offer for every customer."""
    return score(features, (trained or train(features)).best)


def ml_offer_actions(features: DataFrame, trained: Trained | None = None) -> DataFrame:
    """Customers per segment and predicted offer: what the bank would act on."""
    return actions(ml_batch_score(features, trained))
