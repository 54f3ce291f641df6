"""Mixing sources to target weights by capped water-filling.

Sources share a total in proportion to their weights.  A source whose share is
above ``max_epochs`` times its size is clamped there, and the excess goes to
the others in proportion to their weights, again until no share is above.  A
source is then taken in whole repetitions and a fractional one: the documents
with the smallest seeded hashes, up to the cut that comes closest to the rest
of the target.  The cut is found on sums per hash range, so neither a document
list nor a hot source ever meets in one task.

Defined results: a NULL text has size 0; a NULL source is a source of its own,
last in order; documents without an id are hashed by their text; rows that
repeat an id are decided alike; an empty table gives an empty result; a source
whose documents are all empty has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankspark.llm.rows import unwrapped, wrapped
from bankspark.sources.scratch import store

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
LEVEL_BITS = 12  # of each of two rounds that narrow the cut down


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(doc_id: Column, text: Column, seed: int) -> Column:
    """A hash of ``HASH_BITS`` bits that other engines can compute too."""
    name = F.coalesce(doc_id.cast("string"), F.md5(text), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, HASH_BITS // 4), 16, 10).cast("long")


def capped_targets(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``sources`` (source_size, weight, ...) with a ``target``: water-filling under a cap per source.

    Each round aggregates to four numbers on the executors; the loop ends when
    a round clamps no further source, after at most as many rounds as sources.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = None, -1
    while True:
        full = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.count_if(full).alias("clamped"),
            F.sum(F.when(full, cap)).alias("given"),
            F.sum(F.when(~full, F.col("weight"))).alias("weights"),
        ).first()
        if row.clamped == clamped or not row.weights:
            break
        clamped = row.clamped
        level = (total * share - (row.given or 0.0)) / row.weights
    full = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
    target = F.when(full | F.lit(level is None or not row.weights), cap).otherwise(F.col("weight") * F.lit(level or 0.0))
    return sources.withColumn("target", F.least(target, cap).cast("double"))


def _cut_cell(cells: DataFrame, start: Column) -> DataFrame:
    """Of each source, the cell of the hash range in which its running size reaches what is wanted."""
    by = Window.partitionBy("source_key").orderBy("cell")
    before = start + F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(before, start)
    return (
        cells.withColumn("before", before)
        .filter((F.col("before") < F.col("want")) & (F.col("want") <= F.col("before") + F.col("size")))
        .select("source_key", "want", F.col("cell").alias("cut"), "before")
    )


def cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole repetitions, and the largest hash that gets one repetition more.

    ``sized`` has source_key, hash and size of every document, ``targets`` source_key,
    source_size and target.
    """
    plan = targets.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    ).withColumn("want", F.col("target") - F.col("whole") * F.col("source_size"))
    wants = plan.select("source_key", "want")
    shift = HASH_BITS - LEVEL_BITS
    found = None
    rows = sized.select("source_key", "hash", "size")
    for _ in range(2):
        cell = F.shiftright("hash", shift)
        if found is None:
            cells = rows.groupBy("source_key", cell.alias("cell")).agg(F.sum("size").alias("size"))
            found = _cut_cell(cells.join(wants, "source_key"), F.lit(0).cast("long"))
        else:
            rows = rows.join(
                found.withColumnRenamed("cut", "outer_cut"), "source_key"
            ).filter(F.shiftright("hash", shift + LEVEL_BITS) == F.col("outer_cut"))
            cells = rows.groupBy("source_key", "want", "before", cell.alias("cell")).agg(F.sum("size").alias("size"))
            found = _cut_cell(cells.withColumnRenamed("before", "start"), F.col("start"))
            rows = rows.drop("outer_cut", "want", "before")
        found = store(found)
        shift -= LEVEL_BITS
    # What is left of a source is one part in 2 ** (2 * LEVEL_BITS) of its documents.
    by = Window.partitionBy("source_key").orderBy("hash")
    left = (
        rows.join(found, "source_key")
        .filter(F.shiftright("hash", shift + LEVEL_BITS) == F.col("cut"))
        .groupBy("source_key", "want", "before", "hash").agg(F.sum("size").alias("size"))
        .withColumn("end", F.col("before") + F.sum("size").over(by))
    )
    # 2 * (end - size) + size <= 2 * want: taking the document brings the source nearer to its target.
    last = left.filter(2 * F.col("end") - F.col("size") <= 2 * F.col("want")).groupBy("source_key").agg(
        F.max("hash").alias("last")
    )
    below = F.shiftleft(F.col("cut"), shift + LEVEL_BITS) - 1
    # 0 < want <= source_size always has a cell.
    limit = (
        F.when(F.col("want") <= 0, F.lit(-1))
        .when(F.col("cut").isNull(), F.raise_error(F.lit("a source has no cut")).cast("long"))
        .otherwise(F.coalesce(F.col("last"), below))
    )
    return (
        plan.join(found.select("source_key", "cut"), "source_key", "left")
        .join(last, "source_key", "left")
        .select("source_key", "source_size", "target", F.col("whole").cast("long").alias("whole"), limit.alias("limit"))
    )


def source_key(source: Column) -> Column:
    """Sources and the missing one under keys that sort by code point, the missing one last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def by_rank(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Weights dealt out to the sources in order, repeating."""
    rank = F.row_number().over(Window.orderBy("source_key")) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))


def plan(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 7,
    carry: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Every document's ``carry`` columns (as carry_0, ...), source_key, size and hash; and the plan per source."""
    key, size, digest = source_key(F.col("source")), word_count(F.col("text")), seeded_hash(F.col("doc_id"), F.col("text"), seed)
    carried = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    sized = store(docs.select(*carried, key.alias("source_key"), size.alias("size"), digest.alias("hash")))
    sources = store(by_rank(sized.groupBy("source_key").agg(F.sum("size").alias("source_size")), weights))
    return sized, store(cuts(sized, capped_targets(sources, share, max_epochs)))


def _copies(digest: Column) -> Column:
    return F.col("whole") + (digest <= F.col("limit")).cast("long")


def mix(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), **settings) -> DataFrame:
    """The ``carry`` columns of every document with ``size``, ``source_size``, ``target`` and ``copies``.

    ``copies`` is how often the mix takes the document: the whole repetitions of its source, and one more for the
    documents of the fractional repetition.
    """
    sized, planned = plan(docs, carry=carry, **settings)
    return sized.join(planned, "source_key").select(
        *(F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)),
        "size", "source_size", "target", _copies(F.col("hash")).alias("copies"),
    )


def mixed_documents(docs: DataFrame, seed: int = 7, **settings) -> DataFrame:
    """The documents themselves, each as often as the mix takes it; their texts are not shuffled."""
    _, planned = plan(docs, seed=seed, **settings)
    rows = wrapped(
        docs, source_key=source_key(F.col("source")), hash=seeded_hash(F.col("doc_id"), F.col("text"), seed)
    ).join(planned, "source_key")
    times = rows.select("doc", _copies(F.col("hash")).cast("int").alias("copies")).filter("copies > 0")
    return unwrapped(times.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))))


def op6_mixing(docs: DataFrame) -> DataFrame:
    return mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


ORACLE = r"""
WITH sized AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, 15))::BIGINT AS hash
    FROM documents
), sources AS (
    SELECT source, source_size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
        sum(source_size) OVER () AS total
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
), filled AS (  -- k: how many of the sources, in the order in which they fill up, are full
    SELECT *, row_number() OVER f AS k,
        coalesce(sum(2.0::DOUBLE * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
        sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM sources WINDOW f AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST)
), level AS (
    SELECT (total * 1.5::DOUBLE - given) / weights AS level
    FROM filled WHERE 2.0::DOUBLE * source_size > weight * ((total * 1.5::DOUBLE - given) / weights)
    ORDER BY k LIMIT 1
), targets AS (
    SELECT source, source_size,
        coalesce(least(weight * (SELECT level FROM level), 2.0::DOUBLE * source_size), 2.0::DOUBLE * source_size) AS target
    FROM sources
), running AS (
    SELECT s.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash) AS upto,
        sum(s.size) OVER (PARTITION BY s.source, s.hash) AS tied
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (size * (whole + CASE WHEN target - whole * source_size > 0
        AND 2 * upto - tied <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
"""
