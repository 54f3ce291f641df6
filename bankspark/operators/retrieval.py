"""Ranked retrieval: the k best documents per question, over stored indexes (see ``search``)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bankspark.operators.search import search_vectors, search_words, store_index, vector_index, word_index

TOP_K = 5


def docs_bm25_topk(documents: DataFrame, questions: DataFrame, k: int = TOP_K, report: Observation | None = None) -> DataFrame:
    """The k best documents per question (question_id, text) by BM25, with the score as citation.

    Returns (question_id, rank, doc_id, score).  Documents that share no term with a question are never returned for
    it.  The index is stored in the shared folder; ``report`` tells how many of the asked terms' postings were read.
    """
    return search_words(store_index(word_index(documents)), questions, k, report)


def docs_cosine_topk(vectors: DataFrame, questions: DataFrame, k: int = TOP_K, report: Observation | None = None) -> DataFrame:
    """The k nearest vectors (doc_id, embedding) per question vector (question_id, embedding).

    Returns (question_id, rank, doc_id, score), exact over all vectors; ``report`` tells how many cells were read.
    """
    return search_vectors(store_index(vector_index(vectors)), questions, k, report)


def topic_vectors(vectors: DataFrame) -> DataFrame:
    """One question vector per label: the mean of all its vectors, as (question_id, embedding)."""
    mean = Summarizer.mean(array_to_vector("embedding"))
    return vectors.filter(F.col("embedding").isNotNull()).groupBy("label").agg(mean.alias("mean")).select(
        F.col("label").cast("bigint").alias("question_id"),
        vector_to_array("mean").alias("embedding"),
    )
