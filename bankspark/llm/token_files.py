"""Token ids in files of compressed planes.

Documents are range-partitioned by id, so parts follow each other in id order.
A part is written as chunks of whole documents; the ids of a chunk are cut into
blocks of fixed size, each block is transposed into byte planes (or bit planes)
and every plane is compressed with zstandard.  The chunk's row holds the ends
of its planes and its documents' lengths; a chunk index beside it has each
chunk's place in the whole sequence, so any block can be read alone.  Rows and
files are Spark's own, so a lost task writes its part again and any store works.

A text is encoded piece by piece.  The tokenizer lower-cases, drops white space
and parts letters, digits and signs, so a text has the ids of its pieces, cut
there and lower-cased where both are plain, and a worker encodes a piece once.
A text with the beginning of a special string is encoded whole.  A tokenizer that
does not work so is refused.

Defined results: a NULL text is an empty one, with only the end id; documents
without an id come last; rows that repeat an id follow each other in the order
of their texts' hashes; an empty table gives no chunk and an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bankspark.llm.token_counts import special_strings, vocabulary_json
from bankspark.llm.words import LOWER, NOT_BLANK, kind_cuts, pieces, slices, utf8
from bankspark.sources.scratch import shared_folder

END_ID = 1
BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 19  # a chunk ends with the document that reaches this many
LEVEL = 1
SLICE = 8 << 20
CACHE_PIECES = 1_000_000
CACHE_LENGTH = 64  # bytes; longer pieces are not kept
TOGETHER = 512  # words encoded as one text
ONE_WORD = "^[ \\t\\n]?[a-z\u00df-\u00f6\u00f8-\u00ff]+$"  # a run of lower-case letters, with a blank before it or not
PROBE = " Ab cd12 (x)\n it's  ÀÉ ñandú 7% "
CHUNK_SCHEMA = (
    "part int, chunk int, part_start long, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
    "plane_ends array<long>, payload binary"
)


def to_planes(ids: np.ndarray, bits: bool = False) -> np.ndarray:
    """The transposed block: one row of bytes per byte (or bit) of the little-endian 32-bit ids."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if not bits:
        return planes
    return np.concatenate([
        np.packbits((planes[:, None, :] >> np.arange(8, dtype=np.uint8)[None, :, None]) & 1, axis=2).reshape(32, -1)
    ])


def from_planes(planes: np.ndarray, n: int, bits: bool = False) -> np.ndarray:
    if bits:
        unpacked = np.unpackbits(planes, axis=1, count=n).reshape(4, 8, n)
        planes = (unpacked << np.arange(8, dtype=np.uint8)[None, :, None]).sum(axis=1, dtype=np.uint8)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def pack(ids: np.ndarray, block: int = BLOCK_IDS, bits: bool = False) -> tuple[list[int], bytes]:
    """Compressed planes of all blocks, one after the other, and where each ends."""
    import zstandard

    compressor = zstandard.ZstdCompressor(level=LEVEL)
    out = [compressor.compress(row.tobytes()) for i in range(0, len(ids), block) for row in to_planes(ids[i : i + block], bits)]
    return np.cumsum([len(x) for x in out], dtype=np.int64).tolist(), b"".join(out)


def unpack(payload: bytes, ends: list[int], n_ids: int, block: int = BLOCK_IDS, bits: bool = False) -> np.ndarray:
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    rows, width = [expand(payload[a:b]) for a, b in zip([0, *ends[:-1]], ends)], 32 if bits else 4
    blocks = []
    for k, i in enumerate(range(0, n_ids, block)):
        planes = np.stack([np.frombuffer(r, dtype=np.uint8) for r in rows[k * width : (k + 1) * width]])
        blocks.append(from_planes(planes, min(block, n_ids - i), bits))
    return np.concatenate(blocks) if blocks else np.empty(0, dtype=np.uint32)


class Encoder:
    """Ids of texts, by their pieces.

    Exact for a tokenizer that drops white space, lower-cases, and parts letters, digits and signs; others are refused.
    Where its tokens tell the end of a word, pieces that are one word each are encoded many in one text.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special_begins = sorted({s[:2] for s in special_strings(tokenizer_json)})
        described = json.loads(tokenizer_json)
        suffix = described["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:
            self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.plain = self.without_patterns(described)
        # What is known of a piece: a number, and by number its ids in the pool.
        self.known: dict[str, int] = {}
        self.sizes = np.empty(0, dtype=np.int64)
        self.pool = np.empty(0, dtype=np.uint32)
        whole = self.tokenizer.encode(PROBE, add_special_tokens=False).ids
        if self.encode(pa.array([PROBE]), 0)[0][:-1].tolist() != whole:
            raise ValueError("the tokenizer does not encode a text piece by piece")

    def without_patterns(self, described: dict):
        """The same merges for lower-case words between blanks, without normalizer and patterns; or the tokenizer itself."""
        from tokenizers import Tokenizer

        parts = described.get("pre_tokenizer") or {}
        bytewise = [p for p in parts.get("pretokenizers", [parts]) if p.get("type") == "ByteLevel"]
        split = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *bytewise]}
        plain = described | {"normalizer": None, "pre_tokenizer": split, "post_processor": None, "added_tokens": []}
        try:
            found = Tokenizer.from_str(json.dumps(plain))
        except Exception:  # noqa: BLE001 - the library raises nothing finer
            return self.tokenizer
        words = "the añadé straße naïve ÿ zzyzx s t"
        same = found.encode(words, add_special_tokens=False).ids == self.tokenizer.encode(words, add_special_tokens=False).ids
        return found if same else self.tokenizer

    def encoded(self, texts: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each has."""
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        sizes = np.fromiter((len(e) for e in found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(e.ids for e in found), dtype=np.uint32, count=int(sizes.sum())), sizes

    def encoded_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only, with many in one text."""
        ids, each = self.encoded([" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)], self.plain)
        ends = np.flatnonzero(self.ends_word[ids])
        held = np.diff(np.searchsorted(ends, np.append(0, np.cumsum(each))))
        if held.tolist() != [min(TOGETHER, len(words) - i) for i in range(0, len(words), TOGETHER)]:
            return self.encoded(words)  # its tokens do not tell words apart
        return ids, np.diff(ends, prepend=-1)

    def of_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where each piece's begin and how many they are."""
        get = self.known.get
        listed = texts.to_pylist()
        number = np.array([get(t, -1) for t in listed], dtype=np.int64)
        fresh = np.flatnonzero(number < 0)
        pool, sizes = self.pool, self.sizes
        if len(fresh):
            unseen = texts.take(pa.array(fresh))
            word = pc.match_substring_regex(unseen, ONE_WORD).to_numpy(zero_copy_only=False)
            long = pc.binary_length(unseen).to_numpy() > CACHE_LENGTH
            order = np.argsort(long, kind="stable")  # what is not kept comes last
            fresh, word = fresh[order], word[order]
            said = [listed[i] for i in fresh]
            words, others = np.flatnonzero(word), np.flatnonzero(~word)
            parts = [self.encoded_words([said[i] for i in words]), self.encoded([said[i] for i in others])]
            place = np.argsort(np.append(words, others))
            own_sizes = np.concatenate([n for _, n in parts])
            begins = np.cumsum(own_sizes) - own_sizes
            own = np.concatenate([ids for ids, _ in parts])[_ranges(begins[place], own_sizes[place])]
            own_sizes = own_sizes[place]
            number[fresh] = len(sizes) + np.arange(len(fresh))
            kept = int((~long).sum())
            pool, sizes = np.append(pool, own), np.append(sizes, own_sizes)
            if len(self.known) + kept <= CACHE_PIECES:
                self.known.update(zip(said[:kept], range(len(self.sizes), len(self.sizes) + kept)))
                self.pool = pool[: len(pool) - int(own_sizes[kept:].sum())]
                self.sizes = sizes[: len(self.sizes) + kept]
        return pool, (np.cumsum(sizes) - sizes)[number], sizes[number]

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column, the end id after each text, and the number of each text's ids."""
        data, offsets = utf8(column)
        if not len(data):
            return np.full(len(column), end_id, dtype=np.uint32), np.ones(len(column), dtype=np.int64)
        word = NOT_BLANK[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        # Blanks are dropped, so they may stay with the word after them.
        cut[1 : len(data)] = (word[:-1] & ~word[1:]) | kind_cuts(data)
        lowered = LOWER[data]
        for begin in self.special_begins:  # special strings are found in the text as it stands
            special = pc.fill_null(pc.match_substring(column, begin), False).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(special):
                cut[offsets[i] : offsets[i + 1]] = False
                lowered[offsets[i] : offsets[i + 1]] = data[offsets[i] : offsets[i + 1]]
        cut[offsets] = True
        cuts = np.flatnonzero(cut)
        coded = pieces(lowered, cuts)
        pool, begins, lengths = self.of_pieces(coded.dictionary)
        codes = coded.indices.to_numpy()
        sizes = lengths[codes]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = pool[_ranges(begins[codes], sizes)]
        text_ends = upto[np.searchsorted(cuts, offsets[1:])]
        return np.insert(ids, text_ends, end_id), np.diff(text_ends, prepend=0) + 1


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from each begin on, as many as its size."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


_encoders: dict[int, Encoder] = {}


def write(docs: DataFrame, tokenizer_json: str, folder: str, end_id: int = END_ID, bits: bool = False) -> None:
    """Write the ids of all documents, in ascending order of doc_id, as ``folder``/chunks and ``folder``/index."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(tokenizer_json)  # one vocabulary
    key = hash(tokenizer_json)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, schema = TaskContext.get().partitionId(), None
        if key not in _encoders:
            _encoders[key] = Encoder(vocabulary.value)
        chunk = start = 0
        doc_ids: list = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            nonlocal chunk, start
            sequence = np.concatenate(ids)
            ends, payload = pack(sequence, bits=bits)
            columns = [
                pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([start], pa.int64()),
                pa.array([len(sequence)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([np.concatenate(lengths)], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())),
                pa.array([payload], pa.binary()),
            ]
            chunk, start = chunk + 1, start + len(sequence)
            doc_ids.clear(), lengths.clear(), ids.clear()
            return pa.RecordBatch.from_arrays(
                columns, ["part", "chunk", "part_start", "n_ids", "doc_ids", "doc_lengths", "plane_ends", "payload"]
            )

        waiting = 0
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                found, sizes = _encoders[key].encode(piece.column("text"), end_id)
                names = piece.column("doc_id").to_pylist()
                # Chunks end where a document reaches the size.
                upto, begin, taken = np.cumsum(sizes), 0, 0
                while begin < len(sizes):
                    stop = min(len(sizes), int(np.searchsorted(upto, taken + CHUNK_IDS - waiting)) + 1)
                    doc_ids.extend(names[begin:stop])
                    lengths.append(sizes[begin:stop])
                    ids.append(found[taken : upto[stop - 1]])
                    waiting += int(upto[stop - 1] - taken)
                    begin, taken = stop, int(upto[stop - 1])
                    if waiting >= CHUNK_IDS:
                        yield row()
                        waiting = 0
        if waiting:
            yield row()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_last(), "tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "tie")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(encode, CHUNK_SCHEMA).write.parquet(f"{folder}/chunks")
    chunks = spark.read.parquet(f"{folder}/chunks").drop("payload")
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))  # a row per part
    ahead = F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    chunks.join(parts, "part").select(
        "part", "chunk", (F.col("ahead") + F.col("part_start")).alias("start"), "n_ids",
        F.size("doc_ids").alias("n_docs"), "plane_ends",
    ).write.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str, bits: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, and its part and chunk."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                value = {n: batch.column(n)[r] for n in batch.schema.names}
                n_ids = value["n_ids"].as_py()
                raw = unpack(value["payload"].as_py(), value["plane_ends"].as_py(), n_ids, bits=bits).tobytes()
                lengths = value["doc_lengths"].values.to_numpy()
                ends = np.cumsum(lengths)
                begins = ends - lengths
                view = memoryview(raw)
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, value["part"].as_py(), dtype=np.int32)),
                        pa.array(np.full(n, value["chunk"].as_py(), dtype=np.int32)),
                        pa.array(value["doc_ids"].as_py(), pa.int64()), pa.array(begins), pa.array(lengths),
                        pa.array(np.array(sums, dtype=np.int64)),
                    ],
                    ["part", "chunk", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    chunks = spark.read.parquet(f"{folder}/chunks").select(
        "part", "chunk", "n_ids", "doc_ids", "doc_lengths", "plane_ends", "payload"
    )
    rows = chunks.mapInArrow(decode, "part int, chunk int, doc_id long, at long, n_tokens long, ids_crc32 long")
    index = spark.read.parquet(f"{folder}/index").select("part", "chunk", "start")
    return rows.join(index, ["part", "chunk"]).select(
        "doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "part", "chunk"
    )


def op2_token_files(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    write(docs, vocabulary_json(public_tokenizers.path("word_bpe_49k.json")), folder)
    return read(spark, folder)
