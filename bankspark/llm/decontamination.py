"""Benchmark decontamination by a prefix-filtered set join.

A window is a run of ``window`` words of a benchmark item (an item of fewer
words is one window).  A document that holds a window holds all its shingles,
so a window's rarest shingle, by document frequency in the corpus, is the
necessary prefix: only where it stands can the window stand.  Documents are
joined to windows on that shingle alone; the place of the shingle in the
window gives the place of the window in the document, which must have room on
both sides; the words themselves are compared last.

Documents are read twice, once for the frequencies of the items' shingles and
once for the places of the prefix shingles.  Both passes look shingles up in a
bit set of bounded size, so only hits leave a task; the joins that follow are
exact, and Spark's to choose.

Defined results: a NULL text has no words; an item without words has no
window; items of the same id count once; an item without an id goes by the
empty string; each repeated document row gets its own result; empty tables
give an empty result or one without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.llm.rows import row_key, unwrapped, wrapped
from bankspark.llm.sketch import bit_set, bits_for, held
from bankspark.llm.words import ALPHANUMERIC, Words, runs, slices, words_of
from bankspark.sources.scratch import store

WINDOW = 10
SHINGLE = 3


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _texts(words: Words) -> list[bytes]:
    data = words.data.tobytes()
    return [data[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())]


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per window and shingle in it: item, words, length, shingle hash, offset, shingle size."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), ALPHANUMERIC, lower=True)
                texts, names = _texts(words), part.column("item").to_pylist()
                hashed = {k: runs(words.hashes(), k) for k in range(1, shingle + 1)}
                rows: list[tuple] = []
                for item, low, high in zip(names, words.first[:-1].tolist(), words.first[1:].tolist()):
                    length = min(window, high - low)
                    size = min(shingle, length)
                    for at in range(low, high - length + 1 if length else low):
                        said = b" ".join(texts[at : at + length]).decode()
                        rows += [
                            (item, said, length, int(_signed(hashed[size][at + o : at + o + 1])[0]), o, size)
                            for o in range(length - size + 1)
                        ]
                names = ["item", "window", "length", "shingle", "offset", "size"]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema([
                    ("item", pa.string()), ("window", pa.string()), ("length", pa.int32()), ("shingle", pa.int64()),
                    ("offset", pa.int32()), ("size", pa.int32()),
                ]))

    named = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")
    )
    return named.mapInArrow(cut, "item string, window string, length int, shingle long, offset int, size int")


def shingle_hits(words: Words, sizes: list[int], bits: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per shingle size: the places of shingles that seem to be in the set, and their hashes."""
    hashes, ends = words.hashes(), words.first[1:]
    docs = words.docs()
    for size in sizes:
        found = runs(hashes, size)
        places = np.flatnonzero(held(bits, found))
        places = places[places + size <= ends[docs[places]]]
        yield size, places, found[places]


def document_frequencies(docs: DataFrame, sizes: list[int], bits: np.ndarray) -> DataFrame:
    """In how many documents each shingle of the set stands."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # of bounded size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), ALPHANUMERIC, lower=True)
                of = words.docs()
                for _, places, found in shingle_hits(words, sizes, shared.value):
                    pairs = np.unique(np.stack([found, of[places].astype(np.uint64)]), axis=1)
                    shingle, documents = np.unique(pairs[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(_signed(shingle)), pa.array(documents)], ["shingle", "documents"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "shingle long, documents long")
    return counted.groupBy("shingle").agg(F.sum("documents").alias("documents"))


def prefix_places(
    docs: DataFrame, sizes: list[int], bits: np.ndarray, window: int, shingle: int, carry: tuple[str, ...]
) -> DataFrame:
    """Every document's ``carry`` columns (as _0, _1, ...) with the places of the prefix shingles in it, each with the words around it."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # of bounded size
    names = ["row", *(f"_{i}" for i in range(len(carry)))]
    place = pa.struct([("shingle", pa.int64()), ("at", pa.int64()), ("lead", pa.int32()), ("around", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), ALPHANUMERIC, lower=True)
                first, of, data = words.first, words.docs(), words.data
                found: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for size, places, hashes in shingle_hits(words, sizes, shared.value):
                    reach = window if size == shingle else size  # a window shorter than a shingle is one itself
                    owners = of[places]
                    lows = np.maximum(first[owners], places - (reach - size)).tolist()
                    highs = np.minimum(first[owners + 1], places + reach).tolist()
                    for doc, at, low, high, h in zip(owners.tolist(), places.tolist(), lows, highs, _signed(hashes).tolist()):
                        text = b" ".join(
                            data[a:b].tobytes() for a, b in zip(words.starts[low:high].tolist(), words.ends[low:high].tolist())
                        )
                        found[doc].append(
                            {"shingle": h, "at": at - int(first[doc]), "lead": at - low, "around": text.decode()}
                        )
                yield pa.RecordBatch.from_arrays(
                    [*map(part.column, names), pa.array(words.counts), pa.array(found, pa.list_(place))],
                    [*names, "n_words", "places"],
                )

    carried = [F.col(c).alias(f"_{i}") for i, c in enumerate(carry)]
    fields = "".join(f"_{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(carry))
    return docs.select(
        F.monotonically_increasing_id().alias("row"), *carried, F.col("text").cast("string").alias("text")
    ).mapInArrow(
        find, f"row long, {fields}n_words long, places array<struct<shingle:long,at:long,lead:int,around:string>>"
    )


def contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Per document: its ``carry`` columns, n_words, n_hit, n_items, items_sha256, contaminated."""
    cut = store(item_windows(items, window, shingle))
    sizes = [r["size"] for r in cut.select("size").distinct().collect()]  # at most ``shingle`` of them
    shingles = cut.select("shingle").distinct()
    known = bit_set(shingles, "shingle", bits_for(shingles.count()))
    frequencies = document_frequencies(docs, sizes, known)
    # The rarest shingle of each window; ties by hash, then by place.
    windows = store(
        cut.select("window", "length", "shingle", "offset").distinct()
        .join(frequencies, "shingle", "left")
        .groupBy("window", "length")
        .agg(F.min(F.struct(F.coalesce("documents", F.lit(0)).alias("documents"), "shingle", "offset")).alias("prefix"))
        .select("window", "length", "prefix.shingle", "prefix.offset")
    )
    prefixes = windows.select("shingle").distinct()
    places = store(prefix_places(docs, sizes, bit_set(prefixes, "shingle", bits_for(prefixes.count())), window, shingle, carry))
    begin = F.col("lead") - F.col("offset")
    around = F.split("around", " ")
    standing = (
        places.select("row", F.inline("places"))
        .join(windows, "shingle")
        .filter((begin >= 0) & (begin + F.col("length") <= F.size(around)))
        .filter(F.array_join(F.slice(around, begin + 1, F.col("length")), " ") == F.col("window"))
        .select("row", (F.col("at") - F.col("offset")).alias("begin"), "length", "window")
    )
    standing = store(standing)
    hit = (
        standing.select("row", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("length") - 1)).alias("word"))
        .distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    )
    found = (
        standing.select("row", "window").distinct()
        .join(cut.select("window", "item").distinct(), "window")
        .groupBy("row").agg(F.collect_set("item").alias("items"))  # of one document
    )
    items_text = F.array_join(F.array_sort(F.coalesce("items", F.array().cast("array<string>"))), ",")
    return (
        places.drop("places").join(hit, "row", "left").join(found, "row", "left")
        .select(
            *(F.col(f"_{i}").alias(c) for i, c in enumerate(carry)), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
            F.sha2(items_text, 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def clean_documents(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents without any window of an item."""
    keyed = docs.select("doc_id", "text", row_key().alias("row_key"))
    found = store(contaminated(keyed, items, carry=("row_key",), **settings).filter("contaminated").select("row_key").distinct())
    return unwrapped(wrapped(docs, row_key=row_key()).join(found, "row_key", "left_anti"))


def op3_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark)


ORACLE = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS said
    FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)
), placed AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS said
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
    SELECT p.doc_id, p.n, p.i, x.item_id FROM placed p JOIN windows x ON p.n = x.n AND p.said = x.said
), marked AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(n)) AS k FROM (SELECT DISTINCT doc_id, n, i FROM hits))
    GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""
