"""Search over classifier settings by successive halving on stratified, seeded folds.

All settings start on a share of the training rows.  After each rung the best
third goes on with three times the rows, until the last one has them all.  No
rung is left with so few rows that its order would be chance: on a small table
all rungs take more, and at last all, of them.
A setting's score is the mean F1 over the folds it was not trained on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.operators.offers import INPUTS, LABEL, SEED, for_training, holdout_scores, ml_split, ready
from bankspark.sources.scratch import store

FOLDS = 3
RATE = 3  # one in so many settings goes on, with so many times the rows
CELL_DIGITS = 3  # hexadecimal digits of the hash by which rows are numbered apart: 4,096 cells a label
LEAST_ROWS = 2_000  # of a rung, where the table has them
AT_ONCE = 4  # fits that run beside each other


def settings() -> dict[str, Callable]:
    common = {"featuresCol": "inputs", "labelCol": "label_index"}
    found: dict[str, Callable] = {}
    for depth in (5, 10, 15):
        found[f"decision_tree depth={depth}"] = DecisionTreeClassifier(maxDepth=depth, seed=SEED, **common)
    for trees, depth in ((20, 8), (40, 10)):
        found[f"random_forest trees={trees} depth={depth}"] = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, **common)
    for penalty in (0.0, 0.01, 0.1):
        found[f"logistic_regression penalty={penalty}"] = LogisticRegression(maxIter=30, regParam=penalty, **common)
    found["naive_bayes"] = NaiveBayes(modelType="gaussian", **common)
    return found


def ml_folds(features: DataFrame, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """(customer_id, next_best_offer, place, fold) of the training customers.

    ``place`` numbers a label's customers from 0 by a seeded hash, so the folds
    of a label differ by one customer at most, on every layout.  Rows are
    numbered within cells of a label and hash prefix and the cells are added up
    beside that, so a label of any size is no single task.  A NULL label is a
    label; repeated customers are numbered each.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("customer_id")))
    rows = (
        ml_split(features).filter("split = 'train'")
        .select("customer_id", LABEL, key.alias("key")).withColumn("cell", F.substring("key", 1, CELL_DIGITS))
    )
    before = Window.partitionBy(LABEL).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(LABEL, "cell").agg(F.count(F.lit(1)).alias("n")).select(
        F.col(LABEL).alias("of"), F.col("cell").alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = F.row_number().over(Window.partitionBy(LABEL, "cell").orderBy("key", "customer_id")) - 1
    placed = rows.withColumn("inside", inside).join(cells, F.col(LABEL).eqNullSafe(F.col("of")) & (F.col("cell") == F.col("at")))
    place = F.col("start") + F.col("inside")
    return placed.select("customer_id", LABEL, place.alias("place"), (place % folds).cast("int").alias("fold"))


def shares(candidates: int, rate: int = RATE, rows: int | None = None, least: int = LEAST_ROWS) -> list[int]:
    """One in how many of the training rows each rung takes: all of them in the rung that a single setting reaches."""
    rungs = 1
    while candidates > 1:
        candidates, rungs = -(-candidates // rate), rungs + 1
    most = max(1, rows // least) if rows is not None else rate ** rungs
    return [min(rate ** k, most) for k in reversed(range(rungs))]


@dataclass
class Step:
    rung: int
    one_in: int
    setting: str
    scores: list[float]  # a fold each
    goes_on: bool = False

    @property
    def mean(self) -> float:
        return fmean(self.scores)


def halving(candidates: dict, score: Callable[[str, int, int], float], folds: int = FOLDS, rate: int = RATE, rows: int | None = None) -> list[Step]:
    """The steps of the search, by rung and falling mean; ``score`` is of (setting, one_in, fold). Ties go to the lesser name."""
    steps: list[Step] = []
    done: dict[tuple, float] = {}
    alive = sorted(candidates)
    for rung, one_in in enumerate(shares(len(alive), rate, rows), 1):
        tasks = [(name, one_in, fold) for name in alive for fold in range(folds)]
        new = [task for task in tasks if task not in done]  # on small tables rungs may be alike
        with ThreadPool(AT_ONCE) as pool:
            done |= dict(zip(new, pool.map(lambda task: score(*task), new)))
        ranked = sorted(
            (Step(rung, one_in, name, [done[name, one_in, fold] for fold in range(folds)]) for name in alive),
            key=lambda s: (-s.mean, s.setting),
        )
        for step in ranked[: -(-len(ranked) // rate)]:
            step.goes_on = True
        alive = [s.setting for s in ranked if s.goes_on]
        steps += ranked
    return steps


def search(features: DataFrame, folds: int = FOLDS, rate: int = RATE) -> list[Step]:
    """Successive halving over ``settings`` on the training customers; test customers are not read.

    The feature table is stored, the assembled rows are kept on memory and disk while models train.
    """
    features = store(features)
    placed = ml_folds(features, folds).select("customer_id", "place", "fold")
    data = for_training(
        VectorAssembler(inputCols=INPUTS, outputCol="inputs").transform(ready(features))
        .select("customer_id", "inputs", LABEL).join(placed, "customer_id"), features.count())
    try:
        indexed = StringIndexer(inputCol=LABEL, outputCol="label_index", stringOrderType="alphabetAsc").fit(data).transform(data)
        candidates = settings()

        def score(name: str, one_in: int, fold: int) -> float:
            taken = F.floor(F.col("place") / folds) % one_in == 0  # every label keeps its share
            model = candidates[name].copy().fit(indexed.filter((F.col("fold") != fold) & taken))
            return holdout_scores(model.transform(indexed.filter(F.col("fold") == fold)))[0]

        return halving(candidates, score, folds, rate, indexed.count())
    finally:
        data.unpersist()


def ml_search(features: DataFrame, steps: list[Step] | None = None) -> DataFrame:
    """(rung, one_in, setting, mean_f1, spread_f1, rank, goes_on): how each setting did; the last rung's first is the choice.

    One row per setting and rung, so a few rows whatever the table.
    """
    steps = search(features) if steps is None else steps
    ranks: dict[int, int] = {}
    rows = []
    for s in steps:
        ranks[s.rung] = ranks.get(s.rung, 0) + 1
        rows.append((s.rung, s.one_in, s.setting, s.mean, pstdev(s.scores), ranks[s.rung], s.goes_on))
    return features.sparkSession.createDataFrame(
        rows, "rung int, one_in int, setting string, mean_f1 double, spread_f1 double, rank int, goes_on boolean"
    )
