"""Quality rules: plain counts, and the divergence of a text from its language.

Per document, one pass counts words, symbols, repeated lines and repeated
windows, a histogram of character classes and one of common words.  The
histograms of all documents that pass the plain rules, each as shares, so that
no long document weighs more than another, add up to a reference per language.  A document of enough words whose Jensen-Shannon distance to its
language's reference is too large is rejected; a shorter one, or one whose
reference has too few words, is not judged by it.

Defined results: a NULL text has no words and fails the plain rules; documents
without a language have a reference of their own; repeated rows stay; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from bankspark.llm.rows import unwrapped, wrapped
from bankspark.llm.words import ALPHANUMERIC, NOT_BLANK, Words, mixed, runs, slices, utf8, words_of
from bankspark.sources.scratch import store

REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
JUDGED_WORDS = 40  # a shorter text is not judged by its histograms
SHARES = 1_000_000  # a document's parts in its language's reference
REFERENCE_WORDS = 2_000  # nor is a text of a language with fewer words
#: The largest distances, and what the root of the number of words adds: chance alone moves a short text further.
MAX_CHAR_DISTANCE, CHAR_SLACK = 0.25, 0.5
MAX_WORD_DISTANCE, WORD_SLACK = 0.20, 2.0

SYMBOLS = b"#*$%&|<>"
# Frequent words of four languages.
COMMON_WORDS = (
    "the of and to in is was for it with that be "
    "der die und den von zu mit für ist das eine "
    "de la le et les des en un une du que pour "
    "el y a los se del las por"
).split()
#: Character classes by leading byte; the ranges beyond ASCII are those of code points below 100, 400, 800, 10000 (hex).
CLASSES = ("lower", "upper", "digit", "blank", "stop", "sign", "control", "latin", "extended", "two_bytes", "three_bytes", "four_bytes")
STOPS = b".,;:!?'\"()-"


def _class_table() -> np.ndarray:
    table = np.full(256, 6, dtype=np.int64)
    table[0x21:0x7F] = 5
    table[0x61:0x7B], table[0x41:0x5B], table[0x30:0x3A] = 0, 1, 2
    table[[0x20, *range(0x09, 0x0E)]] = 3
    table[list(STOPS)] = 4
    table[0xC2:0xC4], table[0xC4:0xD0], table[0xD0:0xE0], table[0xE0:0xF0], table[0xF0:] = 7, 8, 9, 10, 11
    return table


CLASS_OF = _class_table()
IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(SYMBOLS)] = True
NOT_NEWLINE = np.ones(256, dtype=bool)
NOT_NEWLINE[0x0A] = False


def _within(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return hashes + mixed(doc.astype(np.uint64) + np.uint64(1))


def _per_doc(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])


def duplicate_lines(column: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lines = words_of(column, NOT_NEWLINE, lower=False)
    filled = np.concatenate([[0], np.cumsum(NOT_BLANK[lines.data])])
    with_word = filled[lines.ends] > filled[lines.starts]
    key = _within(lines.docs(), lines.hashes())
    _, earliest = np.unique(np.where(with_word, key, np.uint64(0)), return_index=True)
    again = with_word.copy()
    again[earliest] = False
    return _per_doc(again, lines.first)


def repeated_words(words: Words, hashes: np.ndarray, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Words inside windows of ``size`` words that stand in their text twice or more."""
    found, docs = runs(hashes, size), words.docs()
    places = np.arange(len(found))
    places = places[places + size <= words.first[1:][docs[: len(found)]]]
    _, which, count = np.unique(_within(docs[places], found[places]), return_inverse=True, return_counts=True)
    places = places[count[which] > 1]
    change = np.zeros(len(words.starts) + 1, dtype=np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + size, -1)
    return _per_doc(np.cumsum(change)[:-1] > 0, words.first)


def measures(docs: DataFrame, common: list[str], carry: list[str]) -> DataFrame:
    """Per document the plain counts and the two histograms, with the ``carry`` columns."""
    listed = words_of(pa.array([" ".join(common)]), NOT_BLANK, lower=False).hashes()
    order = np.argsort(listed)
    ranked = listed[order]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "common", "total_chars", "total_common"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                column, n = part.column("_text"), part.num_rows
                words = words_of(column, NOT_BLANK, lower=False)
                data = words.data
                starts_char = (data & 0xC0) != 0x80
                _, doc_ends = utf8(column)
                inside = _per_doc(starts_char & NOT_BLANK[data], doc_ends)
                of_byte = np.repeat(np.arange(n), np.diff(doc_ends))
                chars = np.bincount(
                    (of_byte * len(CLASSES) + CLASS_OF[data])[starts_char], minlength=n * len(CLASSES)
                ).reshape(n, -1)
                plain = words_of(column, ALPHANUMERIC, lower=True)
                hashes = plain.hashes()
                at = np.minimum(np.searchsorted(ranked, hashes), len(ranked) - 1)
                kind = np.where(ranked[at] == hashes, order[at], len(common))
                width = len(common) + 1
                histogram = np.bincount(plain.docs() * width + kind, minlength=n * width).reshape(n, -1)
                values = [
                    pa.array(words.counts), pa.array(inside), pa.array(_per_doc(IS_SYMBOL[data], doc_ends)),
                    pa.array(duplicate_lines(column)), pa.array(repeated_words(words, words.hashes())),
                    _rows(chars), _rows(histogram), pa.array(chars.sum(axis=1)), pa.array(histogram.sum(axis=1)),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f"_{i}") for i in range(len(carry))), *values], [*(f"_{i}" for i in range(len(carry))), *names]
                )

    carried = [F.col(c).alias(f"_{i}") for i, c in enumerate(carry)]
    fields = [StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(carry)]
    fields += [StructField(name, ArrayType(LongType()) if name in ("chars", "common") else LongType()) for name in names]
    return docs.select(*carried, F.col("text").cast("string").alias("_text")).mapInArrow(
        measure, StructType(fields)
    )


def _rows(table: np.ndarray) -> pa.Array:
    n, width = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(table.reshape(-1).astype(np.int64)))


def distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms; NULL if one is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda t, x: t + x)
    share = lambda a: F.transform(a, lambda x: x / total(a))
    term = lambda p, q: F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
    terms = F.zip_with(share(left), share(right), lambda p, q: (term(p, q) + term(q, p)) / 2)
    return F.when((total(left) > 0) & (total(right) > 0), F.sqrt(F.greatest(total(terms), F.lit(0.0))))


def references(measured: DataFrame, language: str) -> DataFrame:
    """Per language the summed histograms of the documents that pass the plain rules."""
    widths = {"chars": len(CLASSES), "common": len(COMMON_WORDS) + 1}
    sums = [
        F.array(*(F.sum(F.expr(f"{name}[{i}] * {SHARES} div nullif(total_{name}, 0)")) for i in range(width))).alias(f"all_{name}")
        for name, width in widths.items()
    ]
    return measured.filter(~base_failed()).groupBy(F.coalesce(F.col(language), F.lit("")).alias("language")).agg(
        F.sum("n_words").alias("language_words"), *sums
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judged(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every document's ``carry`` columns with its counts, distances, base_failed and kept."""
    columns = [*carry, *(c for c in ("lang",) if c not in carry)]
    measured = store(measures(docs, COMMON_WORDS, columns))
    lang = f"_{columns.index('lang')}"
    known = store(references(measured, lang))
    placed = measured.withColumn("language", F.coalesce(F.col(lang), F.lit(""))).join(known, "language", "left")
    far = lambda a, b, most, slack: F.coalesce(
        distance(F.col(a), F.col(b)) > most + slack / F.sqrt("n_words"), F.lit(False)
    )
    diverges = (
        (F.col("n_words") >= JUDGED_WORDS)
        & (F.coalesce("language_words", F.lit(0)) >= REFERENCE_WORDS)
        & (far("chars", "all_chars", MAX_CHAR_DISTANCE, CHAR_SLACK) | far("common", "all_common", MAX_WORD_DISTANCE, WORD_SLACK))
    )
    return placed.select(
        *(F.col(f"_{i}").alias(c) for i, c in enumerate(carry)),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~diverges).alias("kept"),
        distance(F.col("chars"), F.col("all_chars")).alias("char_distance"),
        distance(F.col("common"), F.col("all_common")).alias("word_distance"),
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass; their texts are stored once, not shuffled."""
    rows = wrapped(docs, text=F.col("text"), lang=F.col("lang"))
    return unwrapped(judged(rows, carry=("doc",)).filter("kept"))


def op4_quality_rules(docs: DataFrame) -> DataFrame:
    return judged(docs).drop("char_distance", "word_distance")


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LISTED = ", ".join(f"'{word}'" for word in COMMON_WORDS)
ORACLE = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 4]) AS n
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM texts WHERE len(w) >= 5)
), repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(5)) AS k FROM windows WHERE n > 1) GROUP BY doc_id
), counts AS (
    SELECT t.doc_id, lang, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM texts t LEFT JOIN repeated r USING (doc_id)
), failed AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
), classes(k, others) AS (VALUES
    (0, '[^a-z]'), (1, '[^A-Z]'), (2, '[^0-9]'), (3, '[^\x20\x09-\x0D]'), (4, '[^.,;:!?''"()\-]'),
    (5, '[^#$%&*+/<=>@\[\\\]^_`{|}~]'), (6, '[^\x00-\x08\x0E-\x1F\x7F]'), (7, '[^\x{80}-\x{FF}]'), (8, '[^\x{100}-\x{3FF}]'),
    (9, '[^\x{400}-\x{7FF}]'), (10, '[^\x{800}-\x{FFFF}]'), (11, '[^\x{10000}-\x{10FFFF}]')
), said AS (
    SELECT doc_id, unnest(regexp_extract_all(""" + _LOWERED + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
), histograms AS (
    SELECT doc_id, 'c' AS kind, k::VARCHAR AS bin, length(regexp_replace(text, others, '', 'g')) AS n FROM counts, classes
    UNION ALL
    SELECT doc_id, 'w', CASE WHEN word IN (""" + _LISTED + r""") THEN word ELSE ' other' END, count(*) FROM said GROUP BY ALL
), bins AS (
    SELECT h.*, f.lang, f.base_failed, sum(n) OVER (PARTITION BY h.doc_id, kind) AS total FROM histograms h JOIN failed f USING (doc_id)
), reference AS (
    SELECT lang, kind, bin, sum((n * 1000000) // total) AS n, sum(sum((n * 1000000) // total)) OVER (PARTITION BY lang, kind) AS total
    FROM bins WHERE NOT base_failed AND total > 0 GROUP BY lang, kind, bin
), languages AS (
    SELECT lang, sum(n_words) AS words FROM failed WHERE NOT base_failed GROUP BY lang
), pairs AS (  -- bins that only the reference has add half of its share there
    SELECT b.doc_id, b.kind, b.n / b.total AS p, coalesce(r.n, 0) / any_value(r.total) OVER (PARTITION BY b.doc_id, b.kind) AS q
    FROM bins b LEFT JOIN reference r ON b.lang = r.lang AND b.kind = r.kind AND b.bin = r.bin WHERE b.total > 0
), distances AS (
    SELECT doc_id, kind, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 + (1 - sum(q)) / 2, 0)) AS d
    FROM pairs GROUP BY doc_id, kind
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (n_words >= 40 AND coalesce(g.words, 0) >= 2000
        AND (coalesce(c.d > 0.25 + 0.5 / sqrt(n_words), false) OR coalesce(w.d > 0.20 + 2.0 / sqrt(n_words), false))) AS kept
FROM failed f LEFT JOIN languages g USING (lang)
LEFT JOIN distances c ON c.doc_id = f.doc_id AND c.kind = 'c' LEFT JOIN distances w ON w.doc_id = f.doc_id AND w.kind = 'w'
"""
