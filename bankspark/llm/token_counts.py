"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded alone; those that come out as their
own single token are proven.  A text is cut where the pre-tokenizer cuts it
whatever stands around, so a piece has the same tokens alone as in its text.
A proven piece counts one; only the others are merged, once per distinct piece.

Cuts are made next to ASCII blanks and between ASCII letters, digits and signs.
Where the pre-tokenizer's cuts hang on more than that (blanks beyond ASCII, odd
control characters, special strings in the text), the whole text is encoded.

Defined results: a NULL text has no bytes and no tokens; other columns are not
read; repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.llm.words import NOT_BLANK, kind_cuts, pieces, slices, utf8

LIMIT = 512
SLICE = 4 << 20
CACHE_PIECES = 600_000  # that a Python worker keeps, about
CACHE_LENGTH = 64  # longer pieces are not kept

_ODD_CONTROL = np.zeros(256, dtype=bool)
_ODD_CONTROL[0x1C:0x20] = True


def vocabulary_json(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def special_strings(tokenizer_json: str) -> list[str]:
    return [t["content"] for t in json.loads(tokenizer_json).get("added_tokens", [])]


def proven_tokens(tokenizer_json: str) -> list[str]:
    """The vocabulary strings that, encoded alone, are their own single token."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    ids = sorted(tokenizer.get_vocab(with_added_tokens=False).values())
    texts = [tokenizer.decode([i], skip_special_tokens=False) for i in ids]
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return [text for i, text, e in zip(ids, texts, encoded) if text and e.ids == [i]]


def odd_blanks(data: np.ndarray) -> np.ndarray:
    """Where a blank beyond ASCII or an odd control character begins."""
    at = np.flatnonzero(_ODD_CONTROL[data] | (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    padded = np.append(data, [0, 0])
    a, b, c = data[at], padded[at + 1], padded[at + 2]
    odd = _ODD_CONTROL[a] | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
    odd |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    odd |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    odd |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    odd |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[odd]


def boundaries(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where texts are cut; texts marked in ``whole`` are not."""
    n = len(data)
    word = NOT_BLANK[data]
    cut = np.zeros(n + 1, dtype=bool)
    before, here = word[:-1], word[1:]
    inner = cut[1:n]
    inner |= before & ~here  # a word ends
    inner |= kind_cuts(data)
    # A word begins: a space before it belongs to it, another blank is a piece of its own.
    begins = np.flatnonzero(~before & here) + 1
    begins = begins[~np.isin(begins, offsets)]
    cut[begins - 1] = True
    cut[begins[data[begins - 1] != 0x20]] = True
    if whole.any():
        for i in np.flatnonzero(whole):
            cut[offsets[i] : offsets[i + 1]] = False
    cut[offsets] = True
    cut[0] = cut[n] = True
    return np.flatnonzero(cut)


class Counter:
    """Tokens of pieces: one if proven, else merged by the library."""

    def __init__(self, tokenizer_json: str, proven: list[str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.proven = dict.fromkeys(proven, 1)
        self.merged: dict[str, int] = {}

    def counts(self, texts: list[str]) -> np.ndarray:
        merged, proven = self.merged, self.proven
        found = [proven.get(t) or merged.get(t) for t in texts]
        rest = [t for t, n in zip(texts, found) if n is None]
        if rest:
            encoded = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
            fresh = {t: len(e) for t, e in zip(rest, encoded)}
            found = [fresh[t] if n is None else n for t, n in zip(texts, found)]
            if len(merged) < CACHE_PIECES:
                merged.update((t, n) for t, n in fresh.items() if len(t) <= CACHE_LENGTH)
        return np.array(found, dtype=np.int64)


_counters: dict[int, Counter] = {}


def count_column(column: pa.Array, counter: Counter, specials: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and tokens of each text."""
    data, offsets = utf8(column)
    sizes = np.diff(offsets)
    if not len(data):
        return sizes, np.zeros(len(sizes), dtype=np.int64)
    whole = np.zeros(len(sizes), dtype=bool)
    whole[np.searchsorted(offsets, odd_blanks(data), side="right") - 1] = True
    for special in specials:
        whole |= pc.fill_null(pc.match_substring(column, special), False).to_numpy(zero_copy_only=False)
    cuts = boundaries(data, offsets, whole)
    coded = pieces(data, cuts)
    per_piece = counter.counts(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    upto = np.concatenate([[0], np.cumsum(per_piece)])[np.searchsorted(cuts, offsets)]
    return sizes, np.diff(upto)


def with_token_counts(docs: DataFrame, tokenizer_json: str, id_column: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """Per document: id, n_bytes, n_tokens and whether the tokens are over the limit."""
    proven = docs.sparkSession.sparkContext.broadcast((tokenizer_json, proven_tokens(tokenizer_json)))  # one vocabulary
    specials = special_strings(tokenizer_json)
    key = hash(tokenizer_json)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _counters:
            _counters[key] = Counter(*proven.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sizes, tokens = count_column(part.column("text"), _counters[key], specials)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes), pa.array(tokens)], ["id", "n_bytes", "n_tokens"]
                )

    kind = docs.schema[id_column].dataType.simpleString()
    counted = docs.select(F.col(id_column).alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(
        count, f"id {kind}, n_bytes long, n_tokens long"
    )
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op5_token_counts(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return with_token_counts(docs, vocabulary_json(public_tokenizers.path("byte_bpe_50k.json")))
