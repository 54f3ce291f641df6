"""One ranking of cited chunks from two: by words and by vectors, fused by reciprocal ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.functions.text import tokens
from bankspark.operators.combine import union_all
from bankspark.operators.documents import docs_chunk_words
from bankspark.operators.search import search_vectors, search_words, store_index, vector_index, word_index
from bankspark.sources.scratch import store

TOP_K = 5
DEPTH = 20  # of each ranking that is fused
CONSTANT = 60  # of reciprocal rank fusion
NEIGHBOURHOOD = 3  # chunks of a document, of which one is cited at most
DIMENSIONS = 64
FUSED_PLACES = 8


def term_vectors(texts: DataFrame, key: str) -> DataFrame:
    """(key, embedding) of texts (key, text) that have a term: how many terms fall into each hash class.

    The class of a term hangs on its first and last character and its length, so that any engine can work it out.
    """
    number = F.expr(f"(ascii(term) * 31 + ascii(right(term, 1)) * 7 + length(term)) % {DIMENSIONS}")
    counted = texts.select(key, F.explode(tokens("text")).alias("term")).groupBy(key, number.alias("at")).agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    held = counted.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("held"))
    return held.select(key, F.transform(
        F.sequence(F.lit(0), F.lit(DIMENSIONS - 1)), lambda d: F.coalesce(F.element_at("held", d), F.lit(0.0))
    ).alias("embedding"))


def fuse(rankings: Sequence[DataFrame]) -> DataFrame:
    """(question_id, doc_id, score) of rankings (question_id, rank, doc_id): the sum of 1 / (60 + rank)."""
    each = union_all([r.select("question_id", "doc_id", (1 / (F.lit(CONSTANT) + F.col("rank"))).alias("part")) for r in rankings])
    return each.groupBy("question_id", "doc_id").agg(F.round(F.sum("part"), FUSED_PLACES).alias("score"))


def docs_cited_chunks(documents: DataFrame, questions: DataFrame, k: int = TOP_K, depth: int = DEPTH) -> DataFrame:
    """(question_id, rank, doc_id, chunk_no, score): the chunks to cite for each question (question_id, text).

    The ``depth`` best chunks by BM25 and by cosine of term vectors are fused; of neighbouring chunks only the best
    stays, so that a citation does not repeat itself.  Equal scores are ordered by document and chunk.
    """
    chunks = store(docs_chunk_words(documents).withColumn("key", F.concat("doc_id", F.lit("#"), "chunk_no")))
    as_docs = chunks.select(F.col("key").alias("doc_id"), "text")
    by_words = search_words(store_index(word_index(as_docs)), questions, depth)
    index = store_index(vector_index(term_vectors(as_docs, "doc_id")))
    by_vectors = search_vectors(index, term_vectors(questions, "question_id"), depth)
    fused = fuse([by_words, by_vectors]).withColumnRenamed("doc_id", "key").join(chunks.drop("text"), "key")
    best_first = (F.desc("score"), "doc_id", "chunk_no")
    near = Window.partitionBy("question_id", "doc_id", F.floor(F.col("chunk_no") / NEIGHBOURHOOD)).orderBy(*best_first)
    ranked = Window.partitionBy("question_id").orderBy(*best_first)
    return (
        fused.withColumn("nth", F.row_number().over(near)).filter("nth = 1")
        .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        .select("question_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "chunk_no", "score")
    )
