"""Languages of texts, word by word.

A model holds, for each language of the labelled documents, how often pairs and
triples of neighbouring letters occur, in a fixed number of hash classes, and
how its letters spread over the scripts.  The script of a word, told from code
point ranges, narrows the languages it may be of; each of these scores it by
the logarithms of its pairs and triples.  Viterbi's algorithm finds the best
path through the words with a penalty for each change of language, so a text
falls into spans, and its language is the one with the most letters.

The paths of many texts are followed at once, a word of each at a time.  A text
of more than ``STRETCH`` words is followed in stretches of that length; a
change of language just at the end of a stretch costs nothing.

Defined results: a NULL text and a text without a letter are ``und`` with score
0; so is every text if there is no labelled document.  Letters of a script that
no language uses count for none; a text of only these gets the commonest
language and score 0.  Documents without an id are held out.  Repeated rows are
documents of their own; equal scores go to the commoner language, then the
first by name; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark.llm.terms import coded, letter_runs
from bankspark.llm.words import mixed, slices, utf8
from bankspark.sources.scratch import store

FOLDS = 5
TRAIN_DOCS = 50_000  # of a language that a model is fitted on, about
MOST_LANGUAGES = 512
CLASSES = 1 << 16  # of letter pairs and triples
SWITCH = 12.0
SMOOTHING = 0.5
LEAST_SHARE = 0.01  # of a language's letters, for a script it uses
OUTSIDE = -100.0  # the score of a word in a script that a language does not use
STRETCH = 4096  # words
CELLS = 1 << 22  # scores worked on at once
UNKNOWN = "und"

# Ranges of Unicode blocks, by script.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Ethiopic": [(0x1200, 0x137F)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
_TABLE = 0x32400  # code points told apart; beyond there are no letters
_NONE, _MARK = 255, 254


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """The script of each letter (0: one of no listed script), and each code point in lower case."""
    kind = np.full(_TABLE, _NONE, dtype=np.uint8)
    lower = np.arange(_TABLE, dtype=np.uint32)
    script = np.zeros(_TABLE, dtype=np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for low, high in ranges:
            script[low : high + 1] = number
    for code in range(_TABLE):
        category = unicodedata.category(chr(code))[0]
        if category == "L":
            kind[code] = script[code]
            small = chr(code).lower()
            lower[code] = ord(small) if len(small) == 1 else code
        elif category == "M":
            kind[code] = _MARK
    return kind, lower


@dataclass
class Terms:
    """Distinct words: their letters, script, and the hash classes of their pairs and triples."""

    letters: np.ndarray
    script: np.ndarray
    features: np.ndarray  # of all words, one after the other
    first: np.ndarray  # where each word's begin, and the end

    @classmethod
    def of(cls, texts: pa.Array) -> Terms:
        said = "\n".join([*texts.to_pylist(), ""])
        code = np.frombuffer(said.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.flatnonzero(code == 0x0A)
        n = len(ends)
        known = code < _TABLE
        kinds, lower = _characters()
        kind = np.full(len(code), _NONE, dtype=np.uint8)
        kind[known] = kinds[code[known]]
        word = np.searchsorted(ends, np.arange(len(code)))
        letter = kind < _MARK
        letters = np.bincount(word[letter], minlength=n)
        width = len(SCRIPTS) + 1
        by_script = np.bincount(word[letter] * width + kind[letter], minlength=n * width).reshape(n, width)
        # Letters and marks in lower case, with a boundary on either side of a word.
        symbol = np.zeros(len(code) + 2, dtype=np.uint64)
        inside = np.flatnonzero(kind != _NONE)
        symbol[inside + 1] = lower[code[inside]]
        here = symbol[1:-1]
        pair = symbol[:-2] * np.uint64(1 << 21) + here
        triple = (pair + np.uint64(1 << 63)) ^ (symbol[2:] << np.uint64(42))
        features = np.stack([mixed(pair + np.uint64(1)), mixed(triple)], axis=1) & np.uint64(CLASSES - 1)
        starts = np.append(0, ends + 1)
        return cls(letters, by_script.argmax(axis=1), features.astype(np.int32).ravel(), 2 * starts)


@dataclass
class Model:
    """Scores by hash class and language (the commonest language first); whether a language uses a script."""

    languages: list[str]
    scores: np.ndarray
    uses: np.ndarray

    @classmethod
    def from_counts(cls, languages: list[str], counts: np.ndarray, letters: np.ndarray) -> Model:
        """From occurrences of each class (languages x classes) and letters in each script (languages x scripts)."""
        share = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * CLASSES)
        uses = letters >= LEAST_SHARE * np.maximum(1, letters.sum(axis=1, keepdims=True))
        return cls(languages, np.ascontiguousarray(np.log(share).T, dtype=np.float32), uses.T)

    def term_scores(self, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
        """(words x languages) scores, and which words are in a script that some language uses."""
        n, k = len(terms.letters), len(self.languages)
        out = np.empty((n, k), dtype=np.float32)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(terms.first, terms.first[i] + CELLS // k, side="right")) - 1)
            j = min(j, n)
            found = self.scores[terms.features[terms.first[i] : terms.first[j]]]
            out[i:j] = np.add.reduceat(found, terms.first[i:j] - terms.first[i], axis=0) / 2
            i = j
        uses = self.uses[terms.script]
        known = uses.any(axis=1) & (terms.letters > 0)
        out[~uses & known[:, None]] = OUTSIDE + out.min(initial=0)
        out[~known] = 0
        return out, known


def best_path(scores: Callable[[np.ndarray], np.ndarray], starts: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """The best language of each word of many sequences (by Viterbi), at most ``CELLS`` scores at once.

    ``scores`` gives the (words x k) scores of words by their numbers; a sequence is a start and a size.
    """
    out = np.zeros(int((starts + sizes).max(initial=0)), dtype=np.int32)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    done = np.cumsum(sizes[order])
    i = 0
    while i < len(order):
        before = done[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(done, before + CELLS // k, side="right")))
        _follow(scores, starts[order[i:j]], sizes[order[i:j]], k, out)
        i = j
    return out


def _follow(scores, starts: np.ndarray, sizes: np.ndarray, k: int, out: np.ndarray) -> None:
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    own, first = scores(at), np.cumsum(sizes) - sizes
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")
    value = own[first].astype(np.float64)
    stayed, came = [None], [None]
    for t in range(1, sizes[0]):
        n = active[t]
        held = value[:n]
        best = held.argmax(axis=1)
        changed = held[np.arange(n), best][:, None] - SWITCH
        stay = held >= changed
        value[:n] = own[first[:n] + t] + np.maximum(held, changed)
        stayed.append(stay)
        came.append(best.astype(np.int32))
    state = value.argmax(axis=1).astype(np.int32)
    for t in range(sizes[0] - 1, -1, -1):
        n = active[t]
        out[starts[:n] + t] = state[:n]
        if t:
            state[:n] = np.where(stayed[t][np.arange(n), state[:n]], state[:n], came[t])


def _labelled(model: Model, part: pa.RecordBatch, spans: bool) -> pa.RecordBatch:
    words = letter_runs(part.column("text"), lower=False)
    codes, texts = coded(words)
    k, n = len(model.languages), part.num_rows
    used, codes = np.unique(codes, return_inverse=True)
    terms = Terms.of(texts.take(pa.array(used)))
    scores, known = model.term_scores(terms) if k else (np.zeros((len(used), 0)), np.zeros(len(used), dtype=bool))
    is_word = terms.letters[codes] > 0
    doc, codes = words.docs()[is_word], codes[is_word]
    counts = np.bincount(doc, minlength=n)
    first = np.cumsum(counts) - counts
    stretches = -(-counts // STRETCH)
    nth = np.arange(stretches.sum()) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    starts = np.repeat(first, stretches) + nth * STRETCH
    sizes = np.minimum(STRETCH, np.repeat(first + counts, stretches) - starts)
    label = best_path(lambda at: scores[codes[at]], starts, sizes, k) if k else np.zeros(len(codes), dtype=np.int32)
    letters = terms.letters[codes]
    counted = np.bincount(doc * max(1, k) + label, weights=letters * known[codes], minlength=n * max(1, k)).reshape(n, -1)
    best, total = counted.argmax(axis=1), np.bincount(doc, weights=letters, minlength=n)
    languages = np.array(model.languages or [UNKNOWN], dtype=object)
    cut = np.append(True, (doc[1:] != doc[:-1]) | (label[1:] != label[:-1]))[: len(doc)]
    begins = np.flatnonzero(cut)
    out = {
        "doc_id": part.column("doc_id"),
        "lang_pred": pa.array(np.where(total > 0, languages[best], UNKNOWN), pa.string()),
        "score": pa.array(counted.max(axis=1) / np.maximum(1, total), pa.float64()),
        "n_spans": pa.array(np.bincount(doc[begins], minlength=n), pa.int64()),
    }
    if spans:
        place = np.append(0, np.cumsum((words.data & 0xC0) != 0x80))  # code points before each byte
        low, high = words.starts[is_word], words.ends[is_word]
        base = place[utf8(part.column("text"))[1]][doc[begins]]
        stops = np.append(begins[1:], len(doc))[: len(begins)] - 1
        held = pa.StructArray.from_arrays(
            [pa.array(languages[label[begins]] if len(begins) else [], pa.string()),
             pa.array(place[low[begins]] - base, pa.int64()), pa.array(place[high[stops]] - base, pa.int64())],
            names=["lang", "start", "end"],
        )
        out["spans"] = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[begins], np.arange(n + 1)), pa.int32()), held)
    return pa.RecordBatch.from_pydict(out)


def label_languages(docs: DataFrame, model: Model, spans: bool = True) -> DataFrame:
    """(doc_id, lang_pred, score, n_spans, spans) of each document (doc_id, text).

    A span is (lang, start, end) in code points, from the first to the last word of a run of one language; ``score``
    is the share of the text's letters in words of its language.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, n_spans bigint"
    if spans:
        schema += ", spans array<struct<lang: string, start: bigint, end: bigint>>"

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _labelled(model, part, spans)

    return docs.select("doc_id", "text").mapInArrow(labelled, schema)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, class, n) of the texts of a task; classes from ``CLASSES`` on are letters by script."""
    held: dict[str, np.ndarray] = {}
    width = CLASSES + len(SCRIPTS) + 1
    for batch in batches:
        for part in slices(batch):
            words = letter_runs(part.column("text"), lower=False)
            codes, texts = coded(words)
            if not len(codes):
                continue
            used, codes = np.unique(codes, return_inverse=True)
            terms = Terms.of(texts.take(pa.array(used)))
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            lang = np.array([names.index(x) for x in langs])[words.docs()]
            for i, name in enumerate(names):
                times = np.bincount(codes[lang == i], minlength=len(used)) * (terms.letters > 0)
                sums = held.setdefault(name, np.zeros(width, dtype=np.int64))
                weights = np.repeat(times, np.diff(terms.first))
                sums[:CLASSES] += np.bincount(terms.features, weights=weights, minlength=CLASSES).astype(np.int64)
                sums[CLASSES:] += np.bincount(terms.script, weights=times * terms.letters, minlength=len(SCRIPTS) + 1).astype(np.int64)
    for name, sums in held.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([name] * len(at), pa.string()), "class": pa.array(at, pa.int32()), "n": pa.array(sums[at], pa.int64()),
        })


def learn(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """A model of documents (text, lang), fitted on about ``train_docs`` of each language, chosen by a hash.

    It holds ``CLASSES`` numbers for each language, and more than ``MOST_LANGUAGES`` languages are refused, so its
    size has a bound and it is sent to every task.
    """
    labelled = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    of_lang = store(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")))
    docs = {r["lang"]: r["docs"] for r in of_lang.limit(MOST_LANGUAGES + 1).collect()}
    if len(docs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    drawn = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) * F.col("docs") < F.lit(train_docs * 1_000_000)
    sample = labelled.join(of_lang, "lang").filter(drawn).select("text", "lang")
    counts = (
        sample.mapInArrow(_feature_counts, "lang string, class int, n bigint")
        .groupBy("lang", "class").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list(F.struct("class", "n")).alias("held"))
    )
    languages = sorted(docs, key=lambda x: (-docs[x], x))
    table = np.zeros((len(languages), CLASSES + len(SCRIPTS) + 1), dtype=np.int64)
    for row in counts.toLocalIterator():
        at, n = zip(*row["held"])
        table[languages.index(row["lang"]), list(at)] = n
    return Model.from_counts(languages, table[:, :CLASSES], table[:, CLASSES:])


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from learning: a fold of its id."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text) % FOLDS == 0


def op13_language_id(documents: DataFrame) -> DataFrame:
    """Learns from the documents that are not held out, and predicts the language of all from their texts alone."""
    model = learn(documents.filter(~held_out()))
    labelled = label_languages(documents, model, spans=False)
    return labelled.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_spans")
