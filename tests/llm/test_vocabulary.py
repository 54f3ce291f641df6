"""Source audit, spelling variants and language identification against plain Python."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bankspark.llm import language_id, source_audit, spelling
from tests.llm.conftest import ascii_lower, clashing, frame


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# Source audit


def audit(rows, min_docs, top):
    words = defaultdict(Counter)
    docs = defaultdict(Counter)
    for _, text, lang, source in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text))
        words[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang, source in words:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        mine = shares(words[lang, source])
        overall = shares(sum((c for (x, _), c in words.items() if x == lang), Counter()))
        others = [s for x, s in words if x == lang and s != source]
        pairs = [(sum(f(mine[t], q) for t, q in shares(words[lang, s]).items()), s) for s in others]
        terms = [(f(mine[t], overall[t]), t) for t in kept if words[lang, source][t] and mine[t] > overall[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def sourced(prose):
    rng = random.Random(3)
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", "ü", None])) for i, t in prose]
    return rows + [(900, "one two three", "xx", "a"), (901, None, "xx", "b"), (902, "12 34", "en", "silent")] + rows[10:14]


@pytest.mark.parametrize("min_docs,block,tile", [(3, 1 << 15, 32), (1, 40, 2), (2, 1 << 15, 1)])
def test_audit_is_brute_force(spark, sourced, monkeypatch, min_docs, block, tile):
    monkeypatch.setattr(source_audit, "BLOCK_ROWS", block)
    docs = clashing(frame(spark, sourced))
    monkeypatch.setattr(source_audit, "TILE", tile)
    assert sorted(rows_of(source_audit.source_divergence(docs, min_docs, 4))) == audit(sourced, min_docs, 4)


def test_audit_of_nothing(spark):
    assert rows_of(source_audit.op11_source_audit(frame(spark, []))) == []
    lone = frame(spark, [(1, "only text", None, None), (2, "", None, "b")])
    assert sorted(rows_of(source_audit.op11_source_audit(lone))) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_shares_beyond_64_bits():
    counts, total = np.array([12_000_000_000, 3]), 10**14
    assert source_audit._shares(counts, np.array([total] * 2)).tolist() == [1 + 10**9 * (c + 2) // total for c in (12_000_000_000, 3)]


def test_tally_hands_on_what_it_holds(spark, sourced, monkeypatch):
    """Counts are the same when a task has to hand them on many times."""
    docs = pa.table({"lang": ["a", "a", "b"] * 40, "source": ["x", "y", "x"] * 40, "text": ["u v u", "v w", "u"] * 40})
    monkeypatch.setattr(source_audit, "HELD_ROWS", 2)
    seen = Counter()
    for batch in source_audit._tallied(iter(docs.to_batches(max_chunksize=7))):
        for row in batch.to_pylist():
            if row["term"] is not None:
                seen[row["lang"], row["term"], "docs"] += row["docs"]
                for source, n in zip(row["sources"], row["counts"]):
                    seen[row["lang"], row["term"], source] += n
    assert seen["a", "u", "x"] == 80 and seen["a", "v", "docs"] == 80 and seen["b", "u", "x"] == 40


# Spelling variants


def misspelt(rows, least):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(words):
    out, forms = {}, {}
    for w, n in words.items():
        near = sorted((-words[o], o) for o in words if o != w and one_apart(w, o))
        best = near[0] if near and -near[0][0] >= 5 * n else None
        forms[w] = best[1] if best else None
        out[w] = (n, len(near), -best[0] if best else None)
    rows = []
    for w, (n, n_near, form_n) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, n, n_near, form_n))
    return sorted(rows)


@pytest.fixture(scope="module")
def misspellings():
    """Words of few letters, so that many are near; some very long, chains of forms, letters of one group."""
    rng = random.Random(8)
    words = {}
    while len(words) < 700:
        size = rng.choice([6, 6, 7, 7, 8, 9])
        words["".join(rng.choice("aenyéÿ") for _ in range(size))] = rng.choice([5, 6, 7, 40, 300])
    giant = "".join(rng.choice("abcd") for _ in range(3_000))
    words |= {giant: 5, giant[:1500] + giant[1501:]: 30, giant[:-1] + "z": 200, "z" * 64: 5, "z" * 65: 25, "z" * 66: 125}
    words |= {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "×÷aaaaa": 9, "aaaaa÷×": 9}
    return words


@pytest.mark.parametrize("bucket,searches,frontier,depths", [
    (1 << 12, 1 << 13, 1 << 19, range(2, 9)), (5, 7, 50, range(2, 5)), (1, 1 << 13, 1 << 19, range(8, 9)),
])
def test_variants_are_brute_force(spark, misspellings, monkeypatch, bucket, searches, frontier, depths):
    for name, value in (("BUCKET", bucket), ("SEARCHES", searches), ("FRONTIER", frontier), ("DEPTHS", depths)):
        monkeypatch.setattr(spelling, name, value)
    words = spark.createDataFrame(list(misspellings.items()), "word string, n bigint")
    assert sorted(rows_of(spelling.variant_groups(words)), key=repr) == sorted(variants(misspellings), key=repr)


def test_trie_search_in_small_steps(misspellings, monkeypatch):
    monkeypatch.setattr(spelling, "FRONTIER", 16)
    monkeypatch.setattr(spelling, "CELLS", 100)
    words = sorted(misspellings)[:120]
    data, starts = spelling._letters(pa.array(words))
    vectors, verifier = spelling._vectors(data, starts), spelling.Verifier(data, starts)
    found = set()
    for a, b in spelling.Trie(vectors).search(vectors):
        near = verifier.near(a, b)
        found |= set(zip(a[near].tolist(), b[near].tolist()))
    assert found == {(i, j) for i, j in itertools.permutations(range(len(words)), 2) if one_apart(words[i], words[j])}


def test_counts_with_noise(spark, prose):
    rng = random.Random(2)
    long_words = ["Zuätzlich", "x" * 80, "×÷" * 40, "abcdefg", "Schlüssel"]
    rows = prose + [(i, " ".join(rng.choices(long_words, k=30))) for i in range(2000, 2150)] + [(None, "x" * 80 + "1abcdefg")]
    docs = clashing(frame(spark, rows))
    found = dict(rows_of(spelling.misspelt_counts(docs, 2)))
    assert found == misspelt(rows, 2)
    assert any(len(w) == 79 for w in found)


def test_variants_of_nothing(spark):
    assert rows_of(spelling.op12_spelling_variants(frame(spark, []))) == []
    assert rows_of(spelling.op12_spelling_variants(frame(spark, [(1, None), (2, "short few 123")]))) == []


# Languages


def best_by_search(scores, k, switch):
    """The best value of any path, by trying all."""
    paths = itertools.product(range(k), repeat=len(scores))
    value = lambda path: sum(s[x] for s, x in zip(scores, path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
    return max(map(value, paths))


def test_best_path_is_exhaustive_search(monkeypatch):
    monkeypatch.setattr(language_id, "CELLS", 40)
    rng = np.random.default_rng(4)
    sizes = np.array([1, 7, 0, 3, 6, 2, 7, 5])
    starts = np.cumsum(sizes) - sizes
    scores = rng.normal(0, 14, (sizes.sum(), 3))
    path = language_id.best_path(lambda at: scores[at], starts, sizes, 3)
    for start, size in zip(starts, sizes):
        if size:
            own, found = scores[start : start + size], path[start : start + size]
            value = own[np.arange(size), found].sum() - language_id.SWITCH * (found[1:] != found[:-1]).sum()
            assert value == pytest.approx(best_by_search(own, 3, language_id.SWITCH))


def speech(rng, n):
    return {
        "en": " ".join(rng.choices("the thing and with what there house other".split(), k=n)),
        "de": " ".join(rng.choices("nicht schon das wird über zwischen gehen auch".split(), k=n)),
        "ru": " ".join(rng.choices("это слово там пошёл где другой".split(), k=n)),
    }


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(6)
    return [(i, speech(rng, rng.randint(3, 40))[lang], lang, "a") for i, lang in enumerate(["en", "de", "ru"] * 60)]


def test_held_out_accuracy(spark, spoken):
    odd = [(500, None, "en", "a"), (501, "12 — … ́", None, "a"), (None, "the other house", None, None), (502, "日本", "en", "a"), (503, "", "ru", "b")]
    docs = clashing(frame(spark, spoken + odd + spoken[:5]))
    found = rows_of(language_id.op13_language_id(docs).select("doc_id", "held_out", "lang_pred", "score"))
    assert len(found) == len(spoken) + 10
    by_id = {r[0]: r[1:] for r in found}
    for doc_id, _, lang, _ in spoken:
        held, predicted, score = by_id[doc_id]
        assert held == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert predicted == lang and 0.5 < score <= 1
    assert by_id[500][1:] == by_id[501][1:] == by_id[503][1:] == ("und", 0.0)
    assert by_id[None] == (True, "en", 1.0)
    assert by_id[502][1:] == ("de", 0.0) or by_id[502][1:] == ("en", 0.0)


def test_spans_of_mixed_text(spark, spoken):
    model = language_id.learn(frame(spark, spoken))
    rng = random.Random(9)
    parts = [speech(rng, 12)["en"], speech(rng, 15)["de"], speech(rng, 9)["ru"], speech(rng, 11)["en"]]
    text = "1. " + ". ".join(parts) + "!"
    row = language_id.label_languages(frame(spark, [(1, text), (2, "…")]), model).orderBy("doc_id").collect()
    assert [s["lang"] for s in row[0]["spans"]] == ["en", "de", "ru", "en"]
    assert [text[s["start"] : s["end"]] for s in row[0]["spans"]] == parts
    assert row[0]["lang_pred"] == "en" and row[0]["n_spans"] == 4 and row[1]["spans"] == []


def test_long_texts_in_stretches(spark, spoken, monkeypatch):
    model = language_id.learn(frame(spark, spoken))
    rng = random.Random(1)
    text = speech(rng, 15_000)["de"] + " " + speech(rng, 9_000)["en"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [text, "das auch"]})
    found = language_id._labelled(model, batch, True).to_pylist()
    assert found[0]["lang_pred"] == "de" and found[0]["n_spans"] == 2 and found[1]["lang_pred"] == "de"
    monkeypatch.setattr(language_id, "STRETCH", 100)
    assert language_id._labelled(model, batch, True).to_pylist()[0]["lang_pred"] == "de"


def test_nothing_learnt(spark):
    docs = frame(spark, [(1, "some text", None, "a"), (2, None, "en", "a")])
    assert {r[2:4] for r in rows_of(language_id.op13_language_id(docs))} == {("und", 0.0)}
    assert rows_of(language_id.op13_language_id(frame(spark, []))) == []


def test_sample_is_bounded(spark, spoken):
    many = frame(spark, [(i, f"{t} nr {i}", lang, s) for i, t, lang, s in spoken * 5])
    few = language_id.learn(many, train_docs=5)
    assert few.languages == ["de", "en", "ru"]


def test_too_many_languages(spark, spoken, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError):
        language_id.learn(frame(spark, spoken))
