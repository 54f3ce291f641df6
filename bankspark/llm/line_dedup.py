"""Line dedup by winnowing.

The lines of a document that hold a word are hashed.  Of every window of
``run`` such lines the smallest hash (the last one, if tied) is a fingerprint,
so two equal runs of that many lines always share one at the same place.
Shorter windows count as well where they say enough: one or two lines that hold
``long`` words, and all lines of a document that has fewer than ``run``; such a
window is its own fingerprint.
Fingerprints whose hash stands anywhere else are kept with the lines around
them; the windows around a fingerprint extend it both ways, and equal windows
are put in order.  A line is deleted if it lies in a window that stands
earlier, by document id and then by place; so repeated runs of any length go
but for their first occurrence, in the same document too.

Shuffled are fingerprints with 2 * run - 1 hashes, never lines; equal hashes
and windows are reduced to a count and a first place before the shuffle, and
the joins back can be split where one of them is very common.

Defined results: a NULL text has no lines and stays NULL; lines without a word
are never compared and stay; documents without an id come last; wholly
repeated rows are one document, both with its result; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankspark.llm.rows import row_key, unwrapped, wrapped
from bankspark.operators.combine import splittable_join
from bankspark.sources.scratch import store

RUN = 3
LONG = 20  # words
HAS_WORD = r"[^\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def fingerprints(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """Per fingerprint: row_key, doc_id, hash, the hashes and numbers of the lines around it, and its windows' size."""
    hashed = F.transform(_lines(F.col("text")), lambda x, i: F.struct(F.xxhash64(x).alias("hash"), i.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("words")))
    filled = F.filter(hashed, lambda x: x.words > 0)
    numbered = F.transform(filled, lambda x, i: F.struct(x.hash.alias("hash"), (-i).alias("order"), x.line.alias("line"), x.words.alias("words")))

    singles_type = "array<array<struct<hash: bigint, order: int, line: int, words: int>>>"

    def around(all_lines: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(all_lines) - run + 1)
        minima = F.array_distinct(F.transform(places, lambda s: F.array_min(F.slice(all_lines, s, run))))

        def one(f: Column) -> Column:
            low = F.greatest(1 - f.order - (run - 1), F.lit(1))
            near = F.slice(all_lines, low, 1 - f.order + run - low)
            return F.struct(
                f.hash.alias("hash"), F.transform(near, lambda x: x.hash).alias("hashes"),
                F.transform(near, lambda x: x.line).alias("lines"), F.lit(run).alias("size"),
            )

        def whole(held: Column) -> Column:
            hashes = F.transform(held, lambda x: x.hash)
            return F.struct(F.xxhash64(hashes).alias("hash"), hashes.alias("hashes"), F.transform(held, lambda x: x.line).alias("lines"), F.size(held).alias("size"))

        n = F.size(all_lines)
        singles = F.transform(F.filter(all_lines, lambda x: x.words >= long), lambda x: F.array(x))
        pairs = F.filter(
            F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda s: F.slice(all_lines, s, 2))).otherwise(F.array().cast(singles_type)),
            lambda p: F.get(p, 0).words + F.get(p, 1).words >= long,
        )
        short = F.when((n > 0) & (n < run), F.array(all_lines)).otherwise(F.array().cast(singles_type))
        own = F.transform(F.concat(singles, pairs, short), whole)
        return F.when(n >= run, F.concat(F.transform(minima, one), own)).otherwise(own)

    return docs.select(row_key().alias("row_key"), "doc_id", F.inline(_let(numbered, around)))


def repeated_runs(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """Per row_key the runs of lines (first, last; counted from 0 in the text) that stand earlier in the corpus."""
    found = store(fingerprints(docs, run, long))
    shared = found.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    begins = F.sequence(F.lit(1), F.size("hashes") - F.col("size") + 1)
    windows = (
        splittable_join(found, shared, "hash")
        .select("row_key", "doc_id", "hashes", "lines", "size", F.explode(begins).alias("at"))
        .select(
            "row_key", "doc_id", F.slice("hashes", F.col("at"), F.col("size")).alias("window"),
            F.element_at("lines", F.col("at")).alias("first"), F.element_at("lines", F.col("at") + F.col("size") - 1).alias("last"),
        )
        .distinct()
    )
    windows = store(windows)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "first")
    firsts = windows.groupBy("window").agg(F.min(place).alias("earliest"), F.count("*").alias("n")).filter("n > 1")
    later = splittable_join(windows, firsts, "window").filter(place != F.col("earliest")).select("row_key", "first", "last").distinct()
    in_row = Window.partitionBy("row_key").orderBy("first")
    reach = F.max("last").over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") <= F.coalesce(reach, F.lit(-1)) + 1, 0).otherwise(1)
    return (
        later.withColumn("opens", opens).withColumn("number", F.sum("opens").over(in_row))
        .groupBy("row_key", "number").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .select("row_key", "first", "last")
    )


def without_repeated_lines(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """The documents with ``text`` rid of later repeated runs, and n_lines and n_deleted."""
    runs = store(repeated_runs(docs, run, long)).groupBy("row_key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    text = F.col("doc").getField("text")
    lines = _lines(text)
    stays = lambda x, i: ~(x.rlike(HAS_WORD) & F.exists("runs", lambda r: (r.first <= i) & (i <= r.last)))
    kept = F.when(F.col("runs").isNull(), lines).otherwise(F.filter(lines, stays))
    # The same join at every size: the runs grow with the documents.
    joined = wrapped(docs, row_key=row_key()).join(runs.hint("merge"), "row_key", "left").select(
        "doc",
        F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(text.isNull(), 0).otherwise(F.size(lines) - F.size(kept)).cast("long").alias("n_deleted"),
        F.when(F.col("runs").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("text"),
    )
    return unwrapped(joined, "n_lines", "n_deleted", "text")


def op1_line_dedup(docs: DataFrame) -> DataFrame:
    return without_repeated_lines(docs.select("doc_id", "text"))


ORACLE = r"""
WITH lines AS (
    SELECT doc_id, string_split(text, chr(10)) AS l FROM documents
), numbered AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM lines
), filled AS (
    SELECT * FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), following AS (
    SELECT doc_id, i, lead(i, 1) OVER w AS j, lead(i, 2) OVER w AS k, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c,
        words AS m, lead(words, 1) OVER w AS n, count(*) OVER (PARTITION BY doc_id) AS filled
    FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM filled)
    WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), windows AS (
    SELECT doc_id, i AS first, k AS last, [a, b, c] AS said FROM following WHERE k IS NOT NULL
    UNION ALL SELECT doc_id, i, j, [a, b] FROM following WHERE j IS NOT NULL AND (m + n >= 20 OR filled = 2)
    UNION ALL SELECT doc_id, i, i, [a] FROM following WHERE m >= 20 OR filled = 1
), later AS (
    SELECT doc_id, first, last FROM windows
    QUALIFY row_number() OVER (PARTITION BY said ORDER BY doc_id, first) > 1
), deleted AS (
    SELECT DISTINCT f.doc_id, f.i FROM filled f JOIN later t ON f.doc_id = t.doc_id AND f.i BETWEEN t.first AND t.last
), rest AS (
    SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.i) AS text
    FROM numbered n LEFT JOIN deleted d ON n.doc_id = d.doc_id AND n.i = d.i WHERE d.i IS NULL GROUP BY n.doc_id
), counted AS (SELECT doc_id, count(*) AS n FROM deleted GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(c.n, 0)::BIGINT AS n_deleted,
    CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text
FROM documents d LEFT JOIN counted c USING (doc_id) LEFT JOIN rest r USING (doc_id)
"""
