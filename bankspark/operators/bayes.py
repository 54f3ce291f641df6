"""Gaussian naive Bayes in closed form: one aggregate fits it, one expression applies it."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from bankspark.operators.offers import INPUTS, LABEL, ml_split, ready

SMOOTHING = 0.001  # share of a column's own whole variance that every label's variance gets on top
LEAST = 1e-9  # added to that, for columns that never vary


def fit(rows: DataFrame, inputs: list[str], label: str) -> list[Row]:
    """Rows, means and variances per label (all rows: ``total``), from one pass with partial sums.

    One row per label comes to the driver, which the short list of offers bounds; rows without a label are left out.
    """
    moments = [f(f"in_{c}").alias(f"{name}_{c}") for c in inputs for name, f in (("mean", F.avg), ("var", F.var_pop))]
    return (
        rows.filter(F.col(label).isNotNull())
        .select(F.col(label).alias("label"), *(F.col(c).cast("double").alias(f"in_{c}") for c in inputs))
        .rollup("label").agg(F.grouping("label").alias("total"), F.count(F.lit(1)).alias("n"), *moments).collect()
    )


def _score(row: Row, whole: Row, inputs: list[str], smoothing: float) -> Column:
    terms = []
    for c in inputs:
        variance = row[f"var_{c}"] + smoothing * whole[f"var_{c}"] + LEAST
        away = F.col(c).cast("double") - F.lit(row[f"mean_{c}"])
        terms.append(F.lit(-0.5 * math.log(variance)) - away * away / F.lit(2 * variance))
    return F.lit(math.log(row["n"] / whole["n"])) + reduce(add, terms)


def most_likely(moments: list[Row], inputs: list[str], smoothing: float = SMOOTHING) -> Column:
    """The label of the highest likelihood, ties to the greatest label; NULL where nothing was learned or an input is NULL."""
    whole = [m for m in moments if m["total"]]
    labels = sorted((m for m in moments if not m["total"]), key=lambda m: m["label"])
    if not labels:
        return F.lit(None).cast("string")
    best = F.array_max(F.array(*(F.struct(_score(m, whole[0], inputs, smoothing).alias("score"), F.lit(m["label"]).alias("label")) for m in labels)))
    return F.when(best.getField("score").isNotNull(), best.getField("label"))


def ml_naive_bayes(features: DataFrame) -> DataFrame:
    """(customer_id, split, next_best_offer, bayes_offer) of every customer, learned from the training customers."""
    rows = ml_split(ready(features))
    moments = fit(rows.filter("split = 'train'"), INPUTS, LABEL)
    return rows.select("customer_id", "split", LABEL, most_likely(moments, INPUTS).alias("bayes_offer"))
