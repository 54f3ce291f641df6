"""Spelling variants: words one letter apart, found in a trie over letter-group counts.

Letters fall into twelve groups.  A word becomes the vector of how many letters
of each group it has, and words are arranged in a trie by these counts, one
group to a level.  One inserted, deleted or replaced letter changes the vector
by one more in at most one group and one less in at most one, so a word's
search goes down depth first with a budget of one surplus and one deficit;
the words of the leaves it reaches are verified letter by letter.

The top levels of the trie are dealt out: each subtree is a bucket, and a word
is searched in the buckets that its budget reaches.  Of two buckets that reach
each other only the lower one's words are sent, so each pair is met once.  The
depth of the cut follows from the sizes of the subtrees; a bucket still too
large is dealt as cells, some of its words against some of its searches.

Defined results: a NULL text has no words; a missing id is empty in the noise
of ``misspelt_counts``; repeated rows count as often as they stand there; of
equally frequent near words the first in code-point order is the form; an
empty table gives an empty result; other columns are not read.  Words may be
of any length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.llm.terms import coded, western_runs
from bankspark.llm.words import slices
from bankspark.sources.scratch import store

LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5  # a form is so many times as frequent
NOISE = 199  # one occurrence of so many loses a letter
SLICE = 8 << 20
HELD_ROWS = 1_000_000  # counts that a task holds before it hands them on
GROUPS = 12  # of letters, the code point modulo this
DEPTHS = range(2, 9)  # levels above the cut
BUCKET = 1 << 12  # words searched as one trie
SEARCHES = 1 << 13  # searches of one trie at once
FRONTIER = 1 << 19  # branches followed at once
WIDE = 64  # letters; longer words are verified one pair at a time
CELLS = 1 << 23  # letters compared at once

_CRC_TABLE = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], dtype=np.uint32)


# Occurrences


def _shifted(ids: list, longest: int) -> np.ndarray:
    """For each id and number of bytes k: the state of a crc32 over ``<id>:`` after k zero bytes.

    A crc32 is linear, so that of ``<id>:<word>`` is this state and the crc32 of the word alone, joined by XOR.
    """
    begun = [zlib.crc32(f"{'' if i is None else i}:".encode()) ^ 0xFFFFFFFF for i in ids]
    out = np.empty((longest + 1, len(ids)), dtype=np.uint32)
    out[0] = begun
    for k in range(longest):
        out[k + 1] = _CRC_TABLE[out[k] & 0xFF] ^ (out[k] >> 8)
    return out


def _misspelt(part: pa.RecordBatch) -> pa.Table | None:
    """(word, n) of the long enough words of a slice, after the noise."""
    words = western_runs(part.column("text"))
    codes, texts = coded(words)
    if not len(codes):
        return None
    letters = pc.utf8_length(texts).to_numpy()
    long_enough = np.flatnonzero(letters[codes] >= LEAST_LETTERS)
    codes, doc = codes[long_enough], words.docs()[long_enough]
    used, codes = np.unique(codes, return_inverse=True)
    said = texts.take(pa.array(used)).to_pylist()
    encoded = [w.encode() for w in said]
    size = np.array([len(w) for w in encoded], dtype=np.int64)
    alone = np.array([zlib.crc32(w, 0xFFFFFFFF) for w in encoded], dtype=np.uint32)
    ids = part.column("doc_id").to_pylist()
    shifted = _shifted(ids, WIDE)
    sizes = size[codes]
    drawn = shifted[np.minimum(sizes, WIDE), doc] ^ alone[codes]
    for i in np.flatnonzero(sizes > WIDE):
        drawn[i] = zlib.crc32(f"{'' if ids[doc[i]] is None else ids[doc[i]]}:{said[codes[i]]}".encode())
    hit = drawn % NOISE == 0
    counts = np.bincount(codes[~hit], minlength=len(used))
    shorter = []
    for i in np.flatnonzero(hit):
        word = said[codes[i]]
        if len(word) > LEAST_LETTERS:
            at = int(drawn[i]) % len(word)
            shorter.append(word[:at] + word[at + 1 :])
    seen = np.flatnonzero(counts)
    return pa.table({
        "word": pa.array([said[i] for i in seen] + shorter, pa.string()),
        "n": pa.array(np.append(counts[seen], np.ones(len(shorter), dtype=np.int64)), pa.int64()),
    })


def _summed(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            found = _misspelt(part)
            if found is not None:
                held.append(found)
            if sum(t.num_rows for t in held) > 2 * HELD_ROWS:
                held = [_summed(held)]
                if held[0].num_rows > HELD_ROWS:
                    yield from held.pop().to_batches(max_chunksize=1 << 16)
    if held:
        yield from _summed(held).to_batches(max_chunksize=1 << 16)


def misspelt_counts(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): runs of letters of six letters or more and how often they occur, ``least_count`` times or more.

    An occurrence whose crc32 over ``<doc_id>:<word>`` is a multiple of 199 has lost the letter at that crc32 modulo
    the word's length.
    """
    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = read.mapInArrow(_counted, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# The trie


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words (each below 256), and where each word begins."""
    data = np.frombuffer("\n".join([*words.to_pylist(), ""]).encode("latin-1"), dtype=np.uint8)
    ends = np.flatnonzero(data == 0x0A)
    return data, np.append(0, ends + 1)


def _vectors(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    n = len(starts) - 1
    word = np.repeat(np.arange(n), np.diff(starts))
    letter = data != 0x0A
    cell = word[letter] * GROUPS + data[letter] % GROUPS
    return np.bincount(cell, minlength=n * GROUPS).reshape(n, GROUPS)


class Trie:
    """Words by their vectors; level k has the distinct runs of the first k + 1 counts."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1])
        self.width = int(vectors.max(initial=0)) + 2
        node = np.zeros(len(vectors), dtype=np.int64)
        self.levels = []
        for counts in vectors[self.order].T:
            keys, node = np.unique(node * self.width + counts, return_inverse=True)
            self.levels.append(keys)
        self.leaf = np.searchsorted(node, np.arange(len(self.levels[-1]) + 1))

    def search(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (search, word) whose vectors differ by at most one surplus and one deficit."""
        n = len(vectors)
        zero = np.zeros(n, dtype=np.int64)
        stack = [(0, np.arange(n), zero, zero.astype(bool), zero.astype(bool))]
        while stack:
            level, asked, node, more, less = stack.pop()
            if not len(asked):
                continue
            if level < GROUPS and len(asked) > FRONTIER:
                half = len(asked) // 2
                stack += [(level, *(x[s] for x in (asked, node, more, less))) for s in (slice(half), slice(half, None))]
                continue
            if level == GROUPS:
                first, fan = self.leaf[node], self.leaf[node + 1] - self.leaf[node]
                done = np.cumsum(fan)
                i = 0
                while i < len(asked):
                    before = done[i - 1] if i else 0
                    j = max(i + 1, int(np.searchsorted(done, before + FRONTIER, side="right")))
                    at = np.arange(done[j - 1] - before) - np.repeat(done[i:j] - fan[i:j] - before, fan[i:j])
                    yield np.repeat(asked[i:j], fan[i:j]), self.order[at + np.repeat(first[i:j], fan[i:j])]
                    i = j
                continue
            branches = []
            for change in (0, 1, -1):
                may = ~more if change > 0 else ~less if change < 0 else np.ones(len(asked), dtype=bool)
                count = vectors[asked, level] + change
                may &= (count >= 0) & (count < self.width)
                at = np.flatnonzero(may)
                key = node[at] * self.width + count[at]
                child = np.searchsorted(self.levels[level], key)
                child[child == len(self.levels[level])] = 0
                there = self.levels[level][child] == key
                at, child = at[there], child[there]
                branches.append((asked[at], child, more[at] | (change > 0), less[at] | (change < 0)))
            stack.append((level + 1, *(np.concatenate(x) for x in zip(*branches))))


def _one_apart(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    return short[at + (len(a) == len(b)) :] == long[at + 1 :]


class Verifier:
    """Whether words are one inserted, deleted or replaced letter apart."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        self.data, self.starts = data, starts
        self.size = np.diff(starts) - 1
        self.width = min(WIDE, int(self.size.max(initial=0))) + 1
        self.padded = np.zeros((len(self.size), self.width), dtype=np.uint8)
        at = starts[:-1, None] + np.arange(self.width)[None, :]
        inside = np.arange(self.width)[None, :] < np.minimum(self.size, self.width)[:, None]
        self.padded[inside] = data[at[inside]]

    def word(self, i: int) -> str:
        return self.data[self.starts[i] : self.starts[i + 1] - 1].tobytes().decode("latin-1")

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), dtype=bool)
        step = max(1, CELLS // self.width)
        for i in range(0, len(a), step):
            out[i : i + step] = self._near(a[i : i + step], b[i : i + step])
        for i in np.flatnonzero(np.maximum(self.size[a], self.size[b]) >= self.width):
            out[i] = _one_apart(self.word(a[i]), self.word(b[i]))
        return out

    def _near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        swap = self.size[a] > self.size[b]
        short, long = np.where(swap, b, a), np.where(swap, a, b)
        x, y = self.padded[short], self.padded[long]
        differ = x != y
        same_size = self.size[short] == self.size[long]
        found = same_size & (differ.sum(axis=1) == 1)
        rest = np.flatnonzero(~same_size & (self.size[long] - self.size[short] == 1))
        if len(rest):
            first = differ[rest].argmax(axis=1)
            after = x[rest, :-1] != y[rest, 1:]
            after &= np.arange(self.width - 1)[None, :] >= first[:, None]
            found[rest] = ~after.any(axis=1)
        return found


NEAR = "word string, n_near bigint, form string, form_n bigint"


def _search_cell(table: pa.Table) -> pa.Table:
    """For each word of a cell: how many near words it meets there, and the most frequent of them."""
    role = table["role"].to_numpy()
    empty = pa.table({c: pa.array([], t) for c, t in zip(("word", "n_near", "form", "form_n"), (pa.string(), pa.int64()) * 2)})
    held, asked = np.flatnonzero(role == 0), np.flatnonzero(role > 0)
    if not len(held) or not len(asked):
        return empty
    words = table["word"].combine_chunks()
    data, starts = _letters(words)
    vectors = _vectors(data, starts)
    n = table["n"].to_numpy()
    place = pc.rank(words, tiebreaker="dense").to_numpy().astype(np.int64)  # code-point order
    verifier = Verifier(data, starts)
    trie = Trie(vectors[held])
    links = []
    for a, b in trie.search(vectors[asked]):
        a, b = asked[a], held[b]
        # Within a bucket each two words meet twice, and every word itself.
        once = (role[a] == 1) | (place[a] < place[b])
        a, b = a[once], b[once]
        near = verifier.near(a, b)
        links.append((a[near], b[near]))
    a, b = (np.concatenate(x) for x in zip(*links)) if links else (np.empty(0, dtype=np.int64),) * 2
    word, other = np.append(a, b), np.append(b, a)
    if not len(word):
        return empty
    order = np.lexsort((place[other], -n[other], place[word]))
    word, other = word[order], other[order]
    first = np.flatnonzero(np.append(True, place[word][1:] != place[word][:-1]))
    return pa.table({
        "word": words.take(pa.array(word[first])), "n_near": np.diff(np.append(first, len(word))),
        "form": words.take(pa.array(other[first])), "form_n": n[other[first]],
    })


def _group_counts(depth: int):
    """How many letters of each of the first groups a word has, as columns."""
    letters = [chr(c) for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)]]
    for g in range(depth):
        own = "".join(c for c in letters if ord(c) % GROUPS == g)
        yield (F.length("word") - F.length(F.translate("word", own, ""))).alias(f"g{g}")


def _cut_depth(words: DataFrame) -> int:
    """The least depth at which no subtree holds more than a bucket, or the greatest allowed."""
    deepest = max(DEPTHS)
    columns = [f"g{i}" for i in range(deepest)]
    sizes = words.select(*_group_counts(deepest)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    held = sizes.rollup(*columns).agg(F.sum("n").alias("n"), F.grouping_id().alias("above"))
    largest = {r["above"]: r["n"] for r in held.groupBy("above").agg(F.max("n").alias("n")).collect()}
    return next((d for d in DEPTHS if largest.get((1 << (deepest - d)) - 1, 0) <= BUCKET), deepest)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of each word (word, n) that has near words: how many, and the most frequent one.

    ``words`` is read several times.
    """
    depth = _cut_depth(words)
    counts = [F.col(f"g{g}") for g in range(depth)]

    def visit(role: int, up: int | None = None, down: int | None = None):
        moved = [c + int(g == up) - int(g == down) for g, c in enumerate(counts)]
        target = F.struct(F.concat_ws(",", *moved).alias("bucket"), F.lit(role).alias("role"))
        return target if down is None else F.when(counts[down] > 0, target)

    visits = [visit(0), visit(2)]
    for up in range(depth):
        visits += [visit(1, up)] + [visit(1, up, down) for down in range(up + 1, depth)]
    routed = words.select("word", "n", *_group_counts(depth)).select("word", "n", F.explode(F.array(*visits)).alias("to")).select(
        "word", "n", "to.bucket", "to.role"
    ).filter("bucket IS NOT NULL")
    parts = lambda wanted, most: F.ceil(F.count_if(wanted) / most)
    sizes = store(
        routed.groupBy("bucket")
        .agg(parts(F.col("role") == 0, BUCKET).alias("parts"), parts(F.col("role") > 0, SEARCHES).alias("asks"))
        .filter("parts > 0 AND asks > 0")
    )
    own = lambda n: F.array(F.pmod(F.xxhash64("word"), n))
    every = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    held, parts, asks = F.col("role") == 0, F.col("parts"), F.col("asks")
    cells = (
        routed.join(sizes, "bucket")
        .withColumn("part", F.explode(F.when(held, own(parts)).otherwise(every(parts))))
        .withColumn("ask", F.explode(F.when(held, every(asks)).otherwise(own(asks))))
    )
    found = cells.select("bucket", "part", "ask", "word", "n", "role").groupBy("bucket", "part", "ask").applyInArrow(_search_cell, NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", "best.form", (-F.col("best.less")).alias("form_n")
    )


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for links (word, form) without cycles: where following them ends.

    Links are doubled in length in each round, and each round is written to the shared folder.
    """
    reached = store(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if reached.join(further, "root", "left_semi").isEmpty():
            return reached
        reached = store(
            reached.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))
        )


def variant_groups(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word (word, n).

    The form of a word is its most frequent near word, if that is ``times`` as frequent; the root is the form's form
    and so on, or the word itself.
    """
    words = store(words)
    near = store(near_words(words))
    formed = words.join(near, "word", "left").withColumn("has_form", F.col("form_n") >= times * F.col("n"))
    formed = store(formed.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(F.when(F.col("has_form"), F.col(c)).alias(c) for c in ("form", "form_n")),
    ))
    roots = last_forms(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_variants(documents: DataFrame) -> DataFrame:
    return variant_groups(misspelt_counts(documents))


ORACLE = r"""
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), counted AS (
    SELECT run, count(*) AS c, concat(doc_id::VARCHAR, ':', run) AS said FROM runs
    WHERE length(run) >= 6 GROUP BY doc_id, run
), drawn AS (
    SELECT run, c, xor(list_reduce(list_concat([4294967295],
            list_transform(range(strlen(said)), lambda i: ('0x' || substr(hex(said), 2 * i + 1, 2))::BIGINT)),
        lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) AS h
    FROM counted, crc_table
), words AS (
    SELECT word, sum(c)::BIGINT AS n FROM (
        SELECT c, CASE WHEN h % 199 <> 0 THEN run
            ELSE substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) END AS word FROM drawn
    ) WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), holes AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS hole
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.hole = b.hole AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word FROM holes a JOIN words b ON a.hole = b.word
    UNION SELECT b.word, a.word FROM holes a JOIN words b ON a.hole = b.word
), ranked AS (
    SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS place
    FROM near JOIN words ON words.word = other
), formed AS (
    SELECT w.word, CASE WHEN r.n >= 5 * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
), walked AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL SELECT walked.word, formed.word, formed.form FROM walked JOIN formed ON formed.word = walked.next
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM walked WHERE next IS NULL) USING (word)
"""
