"""Divergence of the sources of a language, from bitmaps per count level.

The kept terms of a language are numbered in blocks, frequent ones first.  For
every group (language and source) and every count that terms have there, a
bitmap holds the numbers of these terms, as words of 64 bits.  Two groups meet
word by word: AND and popcount give the number of terms in each joint cell
(count here, count there), which is multiplied by the cell's divergence.
Cells with a count of zero follow by complement from the sizes of the levels
and of the block.  A task gets one block and two tiles of sources, so what it
holds is bounded whatever the number of terms and sources.

All numbers are whole numbers: with N occurrences of kept terms in a group and
V kept terms, a term of count c has the share p = 1 + floor(10^9 (c + 2) / (N + 2 V)),
and p and q diverge by floor((p - q)^2 / (p + q)).

Defined results: NULL texts, languages and sources are empty strings; a group
without terms takes part with counts of zero; where a language keeps no term
all its pairs have the value 0; repeated rows are documents of their own; ties
are ranked by item; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.llm.terms import coded, letter_runs
from bankspark.llm.words import slices
from bankspark.sources.scratch import store

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
HELD_ROWS = 1_500_000  # counts that a task holds before it hands them on
BLOCK_ROWS = 1 << 15  # counts numbered in one block, about
TILE = 32  # sources
CELLS = 1 << 20  # joint cells worked on at once

COUNTS = "lang string, term string, sources array<string>, counts array<bigint>, docs bigint"
PARTS = "lang string, a int, b int, value bigint"


class _Tally:
    """Counts per group and term, of many slices."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.tables: list[pa.Table] = []

    def add(self, part: pa.RecordBatch) -> None:
        pairs = list(zip(part.column("lang").to_pylist(), part.column("source").to_pylist()))
        group = np.array([self.groups.setdefault(p, len(self.groups)) for p in pairs], dtype=np.int64)
        words = letter_runs(part.column("text"))
        codes, texts = coded(words)
        if not len(codes):
            return
        doc = words.docs()
        # One sort by group, term and document gives occurrences and documents of each term.
        key = np.sort((group[doc] * len(texts) + codes) * part.num_rows + doc)
        held, doc_starts = key // part.num_rows, np.append(True, key[1:] != key[:-1])
        starts = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        self.tables.append(pa.table({
            "group": held[starts] // len(texts),
            "term": texts.take(pa.array(held[starts] % len(texts))).cast(pa.large_string()),
            "n": np.diff(np.append(starts, len(key))),
            "docs": np.add.reduceat(doc_starts.astype(np.int64), starts),
        }))
        if sum(t.num_rows for t in self.tables) > 2 * HELD_ROWS:
            self.tables = [self.summed()]

    def summed(self) -> pa.Table:
        held = pa.concat_tables(self.tables).group_by(["group", "term"], use_threads=False)
        return held.aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(["group", "term", "n", "docs"])

    def batches(self) -> Iterator[pa.RecordBatch]:
        """A row for each language and term, its sources side by side; and one per language with all sources seen."""
        langs = np.array([lang for lang, _ in self.groups], dtype=object)
        sources = pa.array([source for _, source in self.groups], pa.string())
        names, lang_of = np.unique(langs, return_inverse=True)
        for i, name in enumerate(names):
            own = sources.filter(pa.array(lang_of == i))
            yield _nested([name], [None], [0, len(own)], own, np.zeros(len(own), dtype=np.int64), [0])
        if not self.tables:
            return
        held = self.summed()
        group = held["group"].to_numpy()
        term = held["term"].combine_chunks().dictionary_encode()
        code = term.indices.to_numpy().astype(np.int64)
        order = np.lexsort((code, lang_of[group]))
        group, code = group[order], code[order]
        n, docs = held["n"].to_numpy()[order], held["docs"].to_numpy()[order]
        key = lang_of[group] * len(term.dictionary) + code
        cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
        seen = np.add.reduceat(docs, cuts[:-1])
        for i in range(0, len(cuts) - 1, 1 << 15):
            j = min(len(cuts) - 1, i + (1 << 15))
            at, inner = cuts[i:j], slice(cuts[i], cuts[j])
            yield _nested(
                names[lang_of[group[at]]], term.dictionary.take(pa.array(code[at])), cuts[i : j + 1] - cuts[i],
                sources.take(pa.array(group[inner])), n[inner], seen[i:j],
            )


def _nested(lang, term, offsets, sources: pa.Array, counts: np.ndarray, docs) -> pa.RecordBatch:
    offsets = pa.array(offsets, pa.int32())
    return pa.RecordBatch.from_pydict({
        "lang": pa.array(lang, pa.string()),
        "term": pa.array(term, pa.string()) if isinstance(term, list) else term.cast(pa.string()),
        "sources": pa.ListArray.from_arrays(offsets, sources),
        "counts": pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
        "docs": pa.array(docs, pa.int64()),
    })


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = _Tally()
    for batch in batches:
        for part in slices(batch):
            tally.add(part)
            if len(tally.tables) == 1 and tally.tables[0].num_rows > HELD_ROWS:
                yield from tally.batches()
                tally = _Tally()
    yield from tally.batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs, total): occurrences in the group; documents and occurrences in the language.

    A row of ``term`` NULL stands for each group that occurs.  One shuffle, of one row per task, language and term.
    """
    texts = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))
    )
    spread = texts.mapInArrow(_tallied, COUNTS).repartition("lang", "term")
    rows = spread.select("lang", "term", "docs", F.posexplode(F.arrays_zip("sources", "counts")).alias("i", "at")).select(
        "lang", "term", F.col("at.sources").alias("source"), F.col("at.counts").alias("n"),
        F.when(F.col("i") == 0, F.col("docs")).otherwise(0).alias("docs"),
    )
    counted = rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    return counted.withColumns({"docs": F.sum("docs").over(of_term), "total": F.sum("n").over(of_term)})


def share(count: str, total: str, kept: str):
    """A term's share, in whole billionths, of a text with ``total`` occurrences of ``kept`` terms."""
    return F.expr(
        f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0))) "
        f"div cast({total} + 2 * {kept} as decimal(20,0))"
    )


def levels(kept: DataFrame) -> DataFrame:
    """(lang, class, block, source, n, word, bits): the bitmap of the terms with count n in the source, 64 to a word.

    Terms of like frequency share a class; a class is cut into blocks by the hash of the term.
    """
    classed = kept.withColumn("class", F.floor(F.log2("total")).cast("int"))
    sizes = store(classed.groupBy("lang", "class").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks")))
    in_block = Window.partitionBy("lang", "class", "block").orderBy(F.desc("total"), "term")
    return (
        classed.join(sizes, ["lang", "class"])
        .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
        .withColumn("id", F.dense_rank().over(in_block) - 1)
        .groupBy("lang", "class", "block", "source", "n", F.expr("id div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(id % 64 as int)))").alias("bits"))
    )


def _shares(counts: np.ndarray, denominators: np.ndarray) -> np.ndarray:
    if len(counts) and counts.max() > 9_000_000_000:  # beyond 64 bits
        counts = counts.astype(object)
    return (1 + (counts + 2) * SCALE // denominators).astype(np.int64)


def diverge(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _meet(key: tuple, table: pa.Table, size_of_tile: int) -> pa.Table:
    """The block's part of the value of each pair of sources of two tiles."""
    lang, _, _, low, high = (k.as_py() for k in key)
    column = {c: table[c].to_numpy() for c in ("idx", "n", "word", "bits", "denominator")}
    here = column["word"] < 0  # a row for each source, with the size of the block
    idx = column["idx"][here]
    order = np.argsort(idx)
    idx, size = idx[order], column["bits"][here][:1].sum()
    zero = _shares(np.zeros(len(idx), dtype=np.int64), column["denominator"][here][order])
    rows = ~here
    at = np.searchsorted(idx, column["idx"][rows])
    order = np.lexsort((column["word"][rows], at))
    at, word = at[order], column["word"][rows][order]
    bits = column["bits"][rows][order].view(np.uint64)
    share_of = _shares(column["n"][rows][order], column["denominator"][rows][order])
    count = np.bitwise_count(bits).astype(np.int64)
    ends = np.searchsorted(at, np.arange(len(idx) + 1))
    tile = idx // size_of_tile
    out = {"a": [], "b": [], "value": []}
    for a in np.flatnonzero(tile == low):
        others = np.flatnonzero((tile == high) & (idx > idx[a]))
        if not len(others):
            continue
        first, stop = ends[others[0]], ends[others[-1] + 1]  # the others are neighbours
        mine, theirs = slice(ends[a], ends[a + 1]), slice(first, stop)
        both = diverge(zero[a], zero[others])
        value = both * size
        # Terms that only a has, as if no other had any; then those of the others alike.
        value += ((diverge(share_of[mine][:, None], zero[others][None, :]) - both) * count[mine][:, None]).sum(axis=0)
        theirs_at = at[theirs] - others[0]
        np.add.at(value, theirs_at, (diverge(zero[a], share_of[theirs]) - both[theirs_at]) * count[theirs])
        for i, j, joint in _joint(word[mine], bits[mine], word[theirs], bits[theirs]):
            p, q, b = share_of[mine][i], share_of[theirs][j], theirs_at[j]
            cell = diverge(p, q) - diverge(p, zero[others][b]) - diverge(zero[a], q) + both[b]
            np.add.at(value, b, cell * joint)
        out["a"].append(np.full(len(others), idx[a]))
        out["b"].append(idx[others])
        out["value"].append(value)
    joined = {k: np.concatenate(v) if v else np.empty(0, dtype=np.int64) for k, v in out.items()}
    return pa.table({
        "lang": pa.array([lang] * len(joined["a"]), pa.string()), "a": pa.array(joined["a"], pa.int32()),
        "b": pa.array(joined["b"], pa.int32()), "value": pa.array(joined["value"], pa.int64()),
    })


def _joint(word_a, bits_a, word_b, bits_b) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries (of a, of b) that have terms in common, and how many: AND and popcount over equal words."""
    order = np.argsort(word_b, kind="stable")
    word_b, bits_b = word_b[order], bits_b[order]
    first = np.searchsorted(word_b, word_a)
    fan = np.searchsorted(word_b, word_a, side="right") - first
    done = np.cumsum(fan)
    i = 0
    while i < len(word_a):
        before = done[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(done, before + CELLS, side="right")))
        left = np.repeat(np.arange(i, j), fan[i:j])
        right = np.arange(len(left)) - np.repeat(done[i:j] - fan[i:j] - before, fan[i:j]) + first[left]
        meet = bits_a[left] & bits_b[right]
        hit = np.flatnonzero(meet)
        yield left[hit], order[right[hit]], np.bitwise_count(meet[hit]).astype(np.int64)
        i = j


def pair_values(levels: DataFrame, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of each two sources of a language, a before b in ``groups`` (lang, source, idx, n_all, v)."""
    placed = levels.join(groups.select("lang", "source", "idx", "n_all", "v"), ["lang", "source"])
    sizes = levels.select("lang", "class", "block", "word", "bits").groupBy("lang", "class", "block", "word").agg(
        F.bit_or("bits").alias("bits")
    ).groupBy("lang", "class", "block").agg(F.sum(F.bit_count("bits")).alias("size"))
    # Languages without a kept term have one empty block.
    none = groups.filter("v = 0").select("lang").distinct().select(
        "lang", F.lit(0).alias("class"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("size")
    )
    present = groups.join(sizes.unionByName(none), "lang").select(
        "lang", "class", "block", "idx", F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("word"),
        F.col("size").alias("bits"), "n_all", "v",
    )
    size_of_tile = TILE

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        return _meet(key, table, size_of_tile)

    tiles = groups.groupBy("lang").agg((F.max("idx") / TILE).cast("int").alias("last_tile"))
    rows = placed.select(*present.columns).unionByName(present).join(tiles, "lang")
    tile, other = F.expr(f"idx div {TILE}").cast("int"), F.col("other")
    return (
        rows.withColumn("other", F.explode(F.sequence(F.lit(0), "last_tile")))
        .select(
            "lang", "class", "block", F.least(tile, other).alias("low"), F.greatest(tile, other).alias("high"),
            "idx", "n", "word", "bits", F.expr("n_all + 2 * v").alias("denominator"),
        )
        .groupBy("lang", "class", "block", "low", "high").applyInArrow(meet, PARTS)
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): each group against the other sources, and its telling terms.

    Part ``pair`` ranks all other sources of the language by divergence; part ``term`` ranks the ``top`` terms that
    are more frequent in the group than in its language by theirs.
    """
    counted = store(term_counts(docs).filter(F.col("term").isNull() | (F.col("docs") >= min_docs)))
    kept = counted.filter(F.col("term").isNotNull())
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    distinct = kept.groupBy("lang", "term").agg(F.first("total").alias("total"))
    of_lang = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_all"))
    in_lang = Window.partitionBy("lang").orderBy("source")
    groups = store(
        counted.filter(F.col("term").isNull()).select("lang", "source")
        .join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
        .na.fill(0, ["n_all", "v", "lang_all"])
        .withColumn("idx", F.row_number().over(in_lang) - 1)
    )
    bitmaps = store(levels(kept))
    names = groups.select("lang", "idx", "source")
    one_way = pair_values(bitmaps, kept, groups)
    both_ways = one_way.unionByName(one_way.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = (
        both_ways.join(names.withColumnRenamed("idx", "a"), ["lang", "a"])
        .join(names.select("lang", F.col("idx").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    telling = (
        kept.join(groups, ["lang", "source"])
        .select("lang", "source", "term", share("n", "n_all", "v").alias("p"), share("total", "lang_all", "v").alias("q"))
        .filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
        .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    )
    return pairs.unionByName(telling)


def op11_source_audit(documents: DataFrame) -> DataFrame:
    return source_divergence(documents)


ORACLE = r"""
WITH words AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, rowid AS doc,
        unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
), grouped AS (
    SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), kept AS (
    SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 10
), of_lang AS (
    SELECT l.lang, count(term) AS v, coalesce(sum(total), 0) AS lang_all
    FROM (SELECT DISTINCT lang FROM grouped) l LEFT JOIN kept USING (lang) GROUP BY ALL
), seen AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), of_group AS (
    SELECT g.lang, g.source, coalesce(sum(n), 0) AS n_all FROM grouped g LEFT JOIN seen USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
        (1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (n_all + 2 * v))::BIGINT AS p,
        (1 + (1000000000::HUGEINT * (total + 2)) // (lang_all + 2 * v))::BIGINT AS q
    FROM of_group g JOIN of_lang USING (lang) JOIN kept k USING (lang) LEFT JOIN seen s
        ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
), summed AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
    FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= 10
"""
