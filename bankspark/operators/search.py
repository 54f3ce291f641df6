"""Stored indexes and exact search in them: the k best rows per question, with bounds that leave most rows out.

An index is a table of packed rows.  Each holds a run of documents or vectors and an upper bound of the score that any
of them can reach.  Questions are rows too, packed into blocks; every packed row meets every block of questions.  A
task goes through the pairs of a packed row and a question by falling bound and leaves out those whose bound is below
the question's k-th score so far.  Only candidates are shuffled, at most k per question and task.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from bankspark.functions.text import tokens
from bankspark.sources.scratch import store

# Executors get the scorers with the task, so this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUESTIONS_PER_BLOCK = 512
TERMS_PER_BLOCK = 20_000  # of questions made of words
MOST_BROADCAST = 8 << 20  # bytes of stored questions
DOCS_PER_SEGMENT = 512
WORDS_PER_SEGMENT = 1 << 18  # so that long documents do not make a large row
ROWS_PER_GROUP = 16  # packed rows of the stored index that a reader decodes at once
TASK_BYTES = 32 << 20  # of packed rows and the questions beside them that one task searches, about
LEAST_BYTES = 2 << 20  # a task that has less is not worth its start
FIRST_READ = 64  # postings read before documents are first left out
LOOKUP = 8  # postings read in the time that one is looked up
VECTORS_PER_CELL = 2048  # of one pivot that are packed into a row, at most
PIVOTS = 64
SAMPLE = 4096  # documents or vectors that pivots and the reference length are taken from
# The two BM25 parameters.
K1 = 1.2
B = 0.75
BM25_PLACES = 4
COSINE_PLACES = 6


class Floors:
    """The k-th best score so far of each question; what lies below it is no candidate."""

    def __init__(self, questions: int, k: int):
        self.best = np.full((questions, k), -np.inf)

    def __getitem__(self, question):
        return self.best[question, 0]

    def offer(self, question: int, scores: np.ndarray) -> np.ndarray:
        """Places of the scores that are among the k best, equal scores by place; they count from now on."""
        k = self.best.shape[1]
        places = np.flatnonzero(scores >= self.best[question, 0])
        places = places[np.argsort(-scores[places], kind="stable")[:k]]
        self.best[question] = np.sort(np.append(self.best[question], scores[places]))[-k:]
        return places


def store_index(index: DataFrame) -> DataFrame:
    """An index written to the shared folder, in row groups of few packed rows, each of which a reader decodes whole."""
    return store(index, **{"parquet.block.row.count.limit": ROWS_PER_GROUP, "parquet.page.size.row.check.min": 1})


def tasks_for(packed_bytes: int, rows: int, asked_bytes: int, blocks: int, cores: int) -> int:
    """How many tasks search ``rows`` packed rows beside all blocks of questions, so that what one has is bounded.

    Spark hands a task's rows to Python in one batch (up to 10,000 rows), so a task must not have many large rows.
    """
    total = packed_bytes * blocks + asked_bytes * rows
    return max(1, -(-total // TASK_BYTES), min(cores, total // LEAST_BYTES))


def _meet(index: DataFrame, packed_bytes: Column, questions: DataFrame, entry: Column, asked_bytes: Column, per_block: int) -> DataFrame:
    """Every packed row beside every block of questions (question_id, ...), an array of ``entry``.

    The blocks are broadcast if the stored questions are small, else they are joined by their number.  Rows are dealt
    out evenly by their bytes, of which the two ``bytes`` columns tell about how many there are.
    """
    questions = store(questions)
    asked = questions.agg(F.count(F.lit(1)).alias("n"), F.sum(asked_bytes).alias("bytes")).first()
    held = index.agg(F.count(F.lit(1)).alias("n"), F.sum(packed_bytes).alias("bytes")).first()
    blocks = max(1, -(-asked["n"] // per_block))
    block = F.pmod(F.xxhash64("question_id"), F.lit(blocks)).alias("block")
    packed = questions.select(block, entry.alias("entry")).groupBy("block").agg(F.collect_list("entry").alias("asked"))
    size = int(str(questions._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    cores = index.sparkSession.sparkContext.defaultParallelism
    tasks = tasks_for(held["bytes"] or 0, held["n"], asked["bytes"] or 0, blocks, cores)
    dealt = lambda pairs: pairs.repartition(tasks) if tasks > 1 else pairs
    if size <= MOST_BROADCAST:
        return dealt(index.withColumn("block", every)).join(F.broadcast(packed), "block")
    return dealt(index.withColumn("block", every).join(packed, "block"))


def _ranked(candidates: DataFrame, k: int, report: Observation | None) -> DataFrame:
    """The k best per question; rows without a score only say how much was read, of how much."""
    if report is not None:
        candidates = candidates.observe(report, F.sum("n_read").alias("n_read"), F.sum("n_asked").alias("n_asked"))
    best_first = Window.partitionBy("question_id").orderBy(F.desc("score"), "doc_id")
    return (
        candidates.filter("score IS NOT NULL").select("question_id", "doc_id", "score")
        .withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= k)
        .select("question_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "score")
    )


def _list(batch: pa.RecordBatch, name: str, row: int) -> pa.Array:
    column = batch.column(name)
    start, stop = column.offsets[row].as_py(), column.offsets[row + 1].as_py()
    return column.values.slice(start, stop - start)


class _Search:
    """Goes through batches of (packed row, block of questions); a subclass gives bounds and scores."""

    def __init__(self, k: int):
        self.k = k
        self.floors: dict[int, Floors] = {}

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, asked = [], {}
            numbers = batch.column("block").to_numpy()
            rows = []
            for row in range(batch.num_rows):
                block = int(numbers[row])
                if block not in asked:
                    asked[block] = self.questions(_list(batch, "asked", row))
                    self.floors.setdefault(block, Floors(len(asked[block][0]), self.k))
                packed, bounds, sizes = self.open(batch, row, asked[block])
                rows.append(packed)
                pairs.append((np.full(len(bounds), row), np.arange(len(bounds)), bounds, sizes))
            if not pairs:
                continue
            row, question, bound, size = (np.concatenate(x) for x in zip(*pairs))
            found_questions, found_docs, scores, n_read = [], [], [], 0
            slack = 10.0 ** -self.places
            for i in np.argsort(-bound, kind="stable"):
                floors, q = self.floors[int(numbers[row[i]])], question[i]
                if bound[i] <= self.nothing or bound[i] + slack < floors[q]:
                    continue
                own, read = self.scores(rows[row[i]], q, floors[q] - slack)
                n_read += read
                own = np.round(own, self.places)
                places = floors.offer(q, np.where(own > self.nothing, own, -np.inf))
                places = places[own[places] > self.nothing]
                if len(places):
                    found_questions.append(asked[int(numbers[row[i]])][0].take(pa.array(np.full(len(places), q))))
                    found_docs.append(_list(batch, "docs", row[i]).take(pa.array(places)))
                    scores.append(own[places])
            ids, docs = batch.column("asked").type.value_type.field("question_id").type, batch.column("docs").type.value_type
            found = pa.array(np.concatenate(scores) if scores else [], pa.float64())
            nothing = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_pydict({
                "question_id": pa.concat_arrays([*found_questions, pa.nulls(1, ids)]),
                "doc_id": pa.concat_arrays([*found_docs, pa.nulls(1, docs)]),
                "score": pa.concat_arrays([found, pa.nulls(1, pa.float64())]),
                "n_read": pa.concat_arrays([nothing, pa.array([n_read], pa.int64())]),
                "n_asked": pa.concat_arrays([nothing, pa.array([int(size.sum())], pa.int64())]),
            })


def _found_schema(index: DataFrame, questions: DataFrame) -> str:
    doc = index.schema["docs"].dataType.elementType.simpleString()
    question = questions.schema["question_id"].dataType.simpleString()
    return f"question_id {question}, doc_id {doc}, score double, n_read bigint, n_asked bigint"


# Words


def _weight(tf: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def _segments(reference: float, per_segment: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = pc.list_value_length(batch.column("terms")).to_numpy().astype(np.int64).cumsum()
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = int(np.searchsorted(ends, before + WORDS_PER_SEGMENT, side="right"))
                stop = min(max(stop, start + 1), start + per_segment, batch.num_rows)
                yield _segment(batch.slice(start, stop - start), reference)
                start = stop

    return pack


def _segment(part: pa.RecordBatch, reference: float) -> pa.RecordBatch:
    """Documents (doc_id, terms) as one row: postings by term, each term with the largest weight it has here."""
    part = part.take(pc.sort_indices(part.column("doc_id"), null_placement="at_start"))
    terms = part.column("terms")
    lengths = pc.list_value_length(terms).to_numpy().astype(np.int64)
    coded = terms.flatten().dictionary_encode()
    doc = np.repeat(np.arange(part.num_rows), lengths)
    key, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * part.num_rows + doc, return_counts=True)
    term, holder = key // part.num_rows, key % part.num_rows
    first = np.searchsorted(term, np.arange(len(coded.dictionary)))
    weights = _weight(tf, lengths[holder], reference)
    tops = np.maximum.reduceat(weights, first) if len(first) else np.empty(0)
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.RecordBatch.from_pydict({
        "docs": one(part.column("doc_id")),
        "lengths": one(pa.array(lengths, pa.int64())),
        "terms": one(coded.dictionary.cast(pa.string())),
        "dfs": one(pa.array(np.diff(np.append(first, len(term))), pa.int64())),
        "holders": one(pa.array(holder, pa.int32())),
        "tfs": one(pa.array(tf, pa.int32())),
        "tops": one(pa.array(tops, pa.float64())),
        "reference": pa.array([reference], pa.float64()),
    })


def word_index(documents: DataFrame, per_segment: int = DOCS_PER_SEGMENT) -> DataFrame:
    """The inverted index of documents (doc_id, text), in segments: one packed row per run of documents, no shuffle.

    A segment has its terms, their postings (document and count) side by side, and for each term the largest weight it
    has in the segment.  Weights hang on the mean length of all documents, which is not known while the index is
    written: they are for a reference length, taken from a bounded sample, and a search scales them so that they stay
    bounds.  Segments of new documents can therefore be added to a stored index.
    """
    split = documents.select("doc_id", tokens(F.coalesce("text", F.lit(""))).alias("terms"))
    sampled = split.limit(SAMPLE).agg(F.avg(F.size("terms"))).first()[0] or 1.0
    doc = documents.schema["doc_id"].dataType.simpleString()
    schema = (
        f"docs array<{doc}>, lengths array<bigint>, terms array<string>, dfs array<bigint>, holders array<int>, "
        "tfs array<int>, tops array<double>, reference double"
    )
    return split.mapInArrow(_segments(float(sampled), per_segment), schema)


@dataclass
class _Segment:
    first: np.ndarray  # of each question's terms, which stand by falling bound
    term: np.ndarray
    idf: np.ndarray
    bound: np.ndarray
    df: np.ndarray
    start: np.ndarray  # of each term's postings
    holders: np.ndarray
    keys: np.ndarray  # of the postings, rising with term and document
    tfs: np.ndarray
    lengths: np.ndarray


class _WordSearch(_Search):
    places, nothing = BM25_PLACES, 0.0

    def __init__(self, k: int, mean: float):
        super().__init__(k)
        self.mean = mean

    def questions(self, asked: pa.Array):
        """The questions of a block, its terms, and (question, term, idf) sorted by question."""
        ids, terms = asked.field("question_id").dictionary_encode(null_encoding="encode"), asked.field("term").dictionary_encode()
        question, term = ids.indices.to_numpy(), terms.indices.to_numpy()
        order = np.argsort(question, kind="stable")
        return ids.dictionary, terms.dictionary, question[order], term[order], asked.field("idf").to_numpy()[order]

    def open(self, batch: pa.RecordBatch, row: int, asked):
        ids, asked_terms, question, term, idf = asked
        place = pc.index_in(asked_terms, value_set=_list(batch, "terms", row))
        there = place.is_valid().to_numpy(zero_copy_only=False)
        place = place.fill_null(0).to_numpy()
        df, top = _list(batch, "dfs", row).to_numpy(), _list(batch, "tops", row).to_numpy()
        # The largest weight for the mean length instead of the reference is at most so much larger.
        scale = max(1.0, self.mean / batch.column("reference")[row].as_py())
        held = there[term] if len(df) else np.zeros(len(term), dtype=bool)
        question, term, idf = question[held], place[term[held]], idf[held]
        bound = idf * top[term] * scale if len(df) else idf
        order = np.lexsort((-bound, question))
        question, term, idf, bound = question[order], term[order], idf[order], bound[order]
        n = len(ids)
        lengths, holders = _list(batch, "lengths", row).to_numpy(), _list(batch, "holders", row).to_numpy()
        packed = _Segment(
            np.searchsorted(question, np.arange(n + 1)), term, idf, bound, df, np.cumsum(df) - df,
            holders, np.repeat(np.arange(len(df)) * len(lengths), df) + holders, _list(batch, "tfs", row).to_numpy(), lengths,
        )
        sizes = df[term] if len(df) else term
        return packed, np.bincount(question, weights=bound, minlength=n), np.bincount(question, weights=sizes, minlength=n)

    def scores(self, packed: _Segment, question: int, floor: float) -> tuple[np.ndarray, int]:
        """Scores of the segment's documents, of those only that reach the floor, and the number of postings read.

        Terms are read by falling bound, in steps; a document goes when what it has and the bounds of the terms left
        do not reach the floor.  When few documents are left, the other terms are looked up for them alone.
        """
        mine = slice(packed.first[question], packed.first[question + 1])
        term, idf = packed.term[mine], packed.idf[mine]
        left = np.append(packed.bound[mine][::-1].cumsum()[::-1][1:], 0)
        low, size = packed.start[term], packed.df[term]
        ends = np.cumsum(size)
        total = np.zeros(len(packed.lengths))
        i, n_read = 0, 0
        while i < len(term):
            j = max(i + 1, int(np.searchsorted(ends, 2 * n_read + FIRST_READ, side="right")))
            own = size[i:j]
            at = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own - low[i:j], own)
            n_read += len(at)
            self.add(total, packed, at, np.repeat(idf[i:j], own))
            if len(total) >= self.k:  # what documents have already is a floor as well
                floor = max(floor, np.partition(total, -self.k)[-self.k] - 10.0 ** -self.places)
            alive = np.flatnonzero(total + left[j - 1] >= floor)
            if not len(alive):
                break
            if len(alive) * (len(term) - j) * LOOKUP < ends[-1] - ends[j - 1]:
                key = (term[j:, None] * len(total) + alive[None, :]).ravel()
                at = np.minimum(np.searchsorted(packed.keys, key), len(packed.keys) - 1)
                hit = np.flatnonzero(packed.keys[at] == key)
                n_read += len(hit)
                self.add(total, packed, at[hit], np.repeat(idf[j:], len(alive))[hit])
                break
            i = j
        out = np.full(len(total), -np.inf)
        out[alive] = total[alive]
        return out, n_read

    def add(self, total: np.ndarray, packed: _Segment, at: np.ndarray, idf: np.ndarray) -> None:
        doc = packed.holders[at]
        weight = idf * _weight(packed.tfs[at], packed.lengths[doc], self.mean)
        total += np.bincount(doc, weights=weight, minlength=len(total))


def search_words(index: DataFrame, questions: DataFrame, k: int, report: Observation | None = None,
                 per_block: int = TERMS_PER_BLOCK) -> DataFrame:
    """The k best documents per question (question_id, text) by BM25: (question_id, rank, doc_id, score).

    ``index`` is a stored ``word_index``.  ``report`` gets how many postings of asked terms were read (``n_read``), of
    how many (``n_asked``).
    """
    asked = store(questions.select("question_id", F.explode(F.array_distinct(tokens("text"))).alias("term")))
    figures = index.agg(
        F.sum(F.size("docs")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("length")
    ).first()
    n, length = figures["n"] or 0, figures["length"] or 0
    known = (
        index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("held")).select("held.terms", "held.dfs")
        .join(asked.select(F.col("term").alias("terms")).distinct(), "terms", "left_semi")
        .groupBy(F.col("terms").alias("term")).agg(F.sum("dfs").alias("df"))
    )
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    askers = asked.join(known, "term").select("question_id", "term", idf.alias("idf"))
    packed_bytes = 12 * F.size("holders") + 32 * F.size("terms") + 24 * F.size("docs")
    pairs = _meet(index, packed_bytes, askers, F.struct("question_id", "term", "idf"), F.lit(32), per_block)
    searched = pairs.mapInArrow(_WordSearch(k, max(1.0, length) / max(1, n)).__call__, _found_schema(index, questions))
    return _ranked(searched, k, report)


# Vectors


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def _numbers(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _cells(pivots: np.ndarray, per_cell: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.take(pc.sort_indices(batch.column("doc_id"), null_placement="at_start"))
            unit = _unit(_numbers(batch.column("embedding"), batch.num_rows))
            near = np.argmax(unit @ pivots.T, axis=1)
            order = np.argsort(near, kind="stable")
            cuts = np.flatnonzero(np.append(True, near[order][1:] != near[order][:-1]))
            for own in np.split(order, cuts[1:]):
                for start in range(0, len(own), per_cell):
                    yield _cell(batch.take(pa.array(own[start : start + per_cell])), unit[own[start : start + per_cell]], pivots[near[own[0]]])

    return pack


def _cell(part: pa.RecordBatch, unit: np.ndarray, pivot: np.ndarray) -> pa.RecordBatch:
    away = np.linalg.norm(unit - pivot, axis=1)
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.RecordBatch.from_pydict({
        "docs": one(part.column("doc_id")), "vectors": one(part.column("embedding").flatten()),
        "pivot": one(pa.array(pivot)), "least": pa.array([away.min()]), "most": pa.array([away.max()]),
    })


def vector_index(vectors: DataFrame, pivots: int = PIVOTS, per_cell: int = VECTORS_PER_CELL) -> DataFrame:
    """Vectors (doc_id, embedding) in cells: one packed row for the vectors of a task around a pivot, no shuffle.

    A cell has its pivot and the least and largest distance of its unit vectors from it.  The pivots come from a
    bounded sample and bear only on how many cells a search can leave out.
    """
    vectors = vectors.filter(F.col("embedding").isNotNull()).select("doc_id", "embedding")
    sampled = np.array([r[0] for r in vectors.select("embedding").limit(SAMPLE).collect()], dtype=np.float64)
    chosen = _spread(_unit(sampled), pivots) if len(sampled) else np.zeros((1, 1))
    doc, kind = (vectors.schema[c].dataType.simpleString() for c in ("doc_id", "embedding"))
    schema = f"docs array<{doc}>, vectors {kind}, pivot array<double>, least double, most double"
    return vectors.mapInArrow(_cells(chosen, per_cell), schema)


def _spread(unit: np.ndarray, n: int) -> np.ndarray:
    """Vectors of the sample far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    away = np.linalg.norm(unit - unit[0], axis=1)
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.linalg.norm(unit - unit[chosen[-1]], axis=1))
    return unit[chosen]


class _VectorSearch(_Search):
    places, nothing = COSINE_PLACES, -np.inf

    def questions(self, asked: pa.Array):
        return asked.field("question_id"), _unit(_numbers(asked.field("embedding"), len(asked)))

    def open(self, batch: pa.RecordBatch, row: int, asked):
        ids, questions = asked
        pivot = _list(batch, "pivot", row).to_numpy()
        n = len(_list(batch, "docs", row))
        vectors = _list(batch, "vectors", row).to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
        away = np.linalg.norm(questions - pivot, axis=1)
        least, most = batch.column("least")[row].as_py(), batch.column("most")[row].as_py()
        # Triangle inequality: no vector of the cell is nearer than this, and unit vectors at distance d have cosine 1 - d^2 / 2.
        nearest = np.maximum(0, np.maximum(away - most, least - away))
        # A null vector has cosine 0 with everything, but distance 1 from unit vectors; so has a null question.
        plain = (np.linalg.norm(questions, axis=1) > 0) & bool(np.any(vectors, axis=1).all())
        bounds = np.where(plain, 1 - nearest**2 / 2, 1.0)
        return (_unit(vectors), questions), bounds, np.ones(len(ids))

    def scores(self, packed, question: int, floor: float) -> tuple[np.ndarray, int]:
        vectors, questions = packed
        return vectors @ questions[question], 1


def search_vectors(index: DataFrame, questions: DataFrame, k: int, report: Observation | None = None,
                   per_block: int = QUESTIONS_PER_BLOCK) -> DataFrame:
    """The k nearest vectors by cosine per question (question_id, embedding), exact: (question_id, rank, doc_id, score).

    ``index`` is a stored ``vector_index``.  ``report`` gets how many cells were read (``n_read``), of how many
    (``n_asked``), for all questions together.
    """
    questions = questions.filter(F.col("embedding").isNotNull()).select("question_id", "embedding")
    packed_bytes = 8 * (F.size("vectors") + F.size("pivot")) + 24 * F.size("docs")
    entry = F.struct("question_id", "embedding")
    pairs = _meet(index, packed_bytes, questions, entry, 16 + 8 * F.size("embedding"), per_block)
    return _ranked(pairs.mapInArrow(_VectorSearch(k).__call__, _found_schema(index, questions)), k, report)
