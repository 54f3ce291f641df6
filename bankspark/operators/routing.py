"""Send each question to the specialist whose description shares most terms with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.functions.text import tokens

NO_SPECIALIST = "none"


def described_terms(descriptions: DataFrame) -> DataFrame:
    """(specialist, term) from hand-written descriptions (specialist, description)."""
    return descriptions.select(
        "specialist", F.explode(F.array_distinct(tokens("description"))).alias("term")
    )


def vocabularies(documents: DataFrame, specialist: str) -> DataFrame:
    """(specialist, term): describe each value of a column by all terms of its documents."""
    return documents.select(
        F.col(specialist).alias("specialist"), F.explode(F.array_distinct(tokens("text"))).alias("term")
    ).distinct()


def overlaps(questions: DataFrame, terms: DataFrame) -> DataFrame:
    """(question keys, specialist, score): distinct question terms found in each description.

    A term that many questions ask is a hot key of the join only on their side,
    which adaptive execution splits; a description has it once.
    """
    keys = [c for c in questions.columns if c != "text"]
    asked = questions.select(*keys, F.explode(F.array_distinct(tokens("text"))).alias("term"))
    return asked.join(terms, "term").groupBy(*keys, "specialist").agg(F.count(F.lit(1)).alias("score"))


def route_questions(questions: DataFrame, terms: DataFrame) -> DataFrame:
    """The best specialist of every question; equal scores go to the first name, no common term to ``none``."""
    keys = [c for c in questions.columns if c != "text"]
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "specialist")
    found = overlaps(questions, terms).withColumn("place", F.row_number().over(best)).filter("place = 1").drop("place")
    return questions.select(*keys).join(found, keys, "left").select(
        *keys, F.coalesce("specialist", F.lit(NO_SPECIALIST)).alias("specialist"), F.coalesce("score", F.lit(0)).alias("score")
    )


def route_multi(questions: DataFrame, terms: DataFrame, at_least: int = 2) -> DataFrame:
    """All specialists that reach the score, by name, for every question; the best one, or ``none``, if none does."""
    keys = [c for c in questions.columns if c != "text"]
    names = F.array_join(F.array_sort(F.collect_set("specialist")), ",")
    reached = (
        overlaps(questions, terms)
        .filter(F.col("score") >= at_least)
        .groupBy(*keys)
        .agg(names.alias("specialists"), F.count(F.lit(1)).alias("n_specialists"))
    )
    alone = (F.col("specialist") != NO_SPECIALIST).cast("bigint")
    return route_questions(questions, terms).join(reached, keys, "left").select(
        *keys, F.coalesce("specialists", "specialist").alias("specialists"), F.coalesce("n_specialists", alone).alias("n_specialists")
    )
