"""The n-gram join, decontamination, line and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bankspark.llm import cells, decontamination, line_dedup, ngram_join, substring_dedup
from bankspark.llm.components import components
from tests.llm.conftest import ascii_lower, blank_words, clashing, frame


def shingles(text, n=5):
    words = blank_words(ascii_lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_components(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return sorted(
        ((d, len(s), (min(least[find(i)]) if least[find(i)] else None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))),
        key=repr,
    )


def test_ngram_join_is_exact(spark, prose):
    got = ngram_join.op8_ngram_join(clashing(frame(spark, prose))).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(prose)


def test_frequency_levels_come_to_the_driver_packed(spark, prose, monkeypatch):
    docs = frame(spark, [r for r in prose if len(r[1] or "") < 5000])
    size, kind, brought = 1 << 16, type(docs), []

    def collect(self, real=kind.collect):
        rows = real(self)
        brought.extend(len(x) if isinstance(x, (bytes, bytearray)) else 8 for row in rows for x in row)
        return rows

    monkeypatch.setattr(kind, "collect", collect)
    levels, total = ngram_join.frequency_levels(docs, size=size)
    assert 0 < sum(brought) <= size  # at most a byte for each class, where counts take eight
    column = pa.array([r.text for r in docs.select("text").toLocalIterator()], pa.string())
    grams = np.concatenate(list(ngram_join.set_hashes(column)))
    counts = np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size)
    expected = np.log2(np.maximum(counts, 1) / max(1.0, counts.mean())) - ngram_join.LEAST_DOUBLINGS + 1
    assert total == len(grams) and levels.max() > 0
    assert levels.tolist() == np.clip(expected, 0, (1 << ngram_join.LEVEL_BITS) - 1).astype(np.uint8).tolist()


def test_frequency_levels_of_nothing(spark):
    levels, total = ngram_join.frequency_levels(frame(spark, [(1, None), (2, "")]), size=1 << 12)
    assert total == 0 and len(levels) == 1 << 12 and not levels.any()


@pytest.mark.parametrize("members", [2, 5])
def test_large_blocks_are_compared_in_cells(spark, members):
    rng = np.random.default_rng(members)
    base = rng.integers(0, 1 << 60, 60)
    sets = []
    for i in range(40):  # a hot group of near copies, and sets that share a few n-grams with it
        x = base.copy()
        x[rng.random(60) < (0.05 if i % 4 else 0.3)] = rng.integers(0, 1 << 60)
        sets.append(np.unique(x).astype(np.uint64))
    nodes = spark.createDataFrame([(7, i) for i in range(40)], "block long, node long")
    payloads = spark.createDataFrame([(i, s.nbytes, s.tobytes()) for i, s in enumerate(sets)], "node long, bytes long, payload binary")
    connected = cells.connected_within_blocks(nodes, payloads, ngram_join.compare_sets(75), cell_members=members)
    roots = {r.node: r.root for r in connected.collect()}
    want = cells.Sets(40)
    for i in range(40):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                want.union(i, j)
    groups = lambda f: sorted(sorted(g) for g in _groups(f, 40))
    assert groups(lambda i: roots.get(i, i)) == groups(want.find)


def _groups(name, n):
    found = defaultdict(list)
    for i in range(n):
        found[name(i)].append(i)
    return found.values()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 31)} | {i: 100 for i in range(101, 160)}


def test_one_document_of_each_group_stays(spark, prose):
    docs = clashing(frame(spark, prose))
    kept = ngram_join.one_per_group(docs)
    assert kept.columns == docs.columns
    want = {(d, t) for (d, t), row in zip(prose, range(len(prose)))} & {
        (d, t) for d, t in prose if any(c == d and x == d and n == len(shingles(t)) for x, n, c in brute_components(prose))
    }
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == {(d, t) for d, t in want}


def test_one_document_stays_without_ids_or_with_a_repeated_one(spark):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(None, base), (None, base + " x"), (None, "y " + base), (None, None), (None, ""), (None, "other words")]
    rows += [(5, base.upper().replace("W", "v")), (5, base.replace("w", "v") + " x"), (None, "y " + base.replace("w", "v"))]
    kept = [(r.doc_id, r.text) for r in ngram_join.one_per_group(frame(spark, rows)).collect()]
    assert len(kept) == 5 and {(None, None), (None, ""), (None, "other words")} < set(kept)
    assert sorted(d for d, t in kept if t and len(t) > 100 and d) == [5]


ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_contamination(rows, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        words = re.findall(ITEM_WORDS, ascii_lower(text))
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add("" if item is None else str(item))
    out = []
    for doc_id, text in rows:
        words = re.findall(ITEM_WORDS, ascii_lower(text))
        hit, found = set(), set()
        for n in range(1, size + 1):
            for i in range(len(words) - n + 1):
                names = windows.get(tuple(words[i : i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def test_decontamination_is_exact(spark, prose):
    texts = [t for _, t in prose if t and len(t) > 200]
    items = [
        (1, " ".join(texts[0].split()[10:40]).upper()), (2, " ".join(texts[-3].split()[:10])), (2, "one two"),
        (3, "!!"), (4, None), (5, "the " * 12), (None, " ".join(texts[5].split()[3:30])), (12, " ".join(texts[0].split()[10:22])),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.op3_decontamination(clashing(frame(spark, prose)), bench)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_contamination(prose, items)
    docs = clashing(frame(spark, prose))
    clean = decontamination.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r[-1] for r in brute_contamination(prose, items))


def test_decontamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontamination.op3_decontamination(frame(spark, [(1, "a b c")]), none).collect())
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.op3_decontamination(frame(spark, []), items).collect() == []


def brute_lines(rows, run=3):
    order = sorted({(d is None, d or 0, t) for d, t in rows if t is not None}, key=lambda x: x[:2])
    assert len({x[:2] for x in order}) == len(order)
    seen, deleted = set(), defaultdict(set)
    for key in order:
        lines = [(i, x) for i, x in enumerate(key[2].split("\n")) if blank_words(x)]
        spans = [(k, size) for size in (1, 2, run) for k in range(len(lines) - size + 1)]
        for k, size in spans:
            window = tuple(x for _, x in lines[k : k + size])
            if size < run and len(lines) != size and sum(len(blank_words(x)) for x in window) < 20:
                continue
            if window in seen:
                deleted[key].update(i for i, _ in lines[k : k + size])
            seen.add(window)
    out = []
    for d, t in rows:
        gone = deleted[(d is None, d or 0, t)] if t is not None else set()
        lines = t.split("\n") if t is not None else []
        out.append((d, len(lines), len(gone), None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return sorted(out, key=repr)


def test_line_dedup_is_exact(spark, prose):
    rows = [r for r in prose if r[0] is not None] + [(900, "a\nb\n\nc\na\nb\nc\nd"), (901, "x\n a\nb\nc\n\nd"), (902, "q\n" * 9)]
    words = " ".join(f"w{i}" for i in range(20))
    half = " ".join(f"h{i}" for i in range(10))
    rows += [(910, "lone"), (911, "\nlone\n "), (912, "lone\nmore"), (913, "lone\nmore"), (914, "more\nlone")]  # whole copies of one and two lines
    rows += [(920, f"p\n{words}\nq"), (921, f"r\n{words}\ns"), (922, words[:-4]), (923, f"r1\n{words[:-4]}")]  # a long line between others
    rows += [(930, f"{half}\n\n{half} x\nt"), (931, f"u\n{half}\n{half} x"), (932, f"{half}\nv")]  # two lines that are long together
    got = line_dedup.op1_line_dedup(clashing(frame(spark, rows)))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_lines(rows)
    assert sum(r.n_deleted for r in got.collect()) > 20
    assert line_dedup.op1_line_dedup(frame(spark, [])).collect() == []
    assert {r.n_deleted for r in line_dedup.op1_line_dedup(frame(spark, [(None, None), (None, "a")])).collect()} == {0}


def test_compact_windows_are_those_of_the_cartesian_tree():
    rng = np.random.default_rng(1)
    for trial in range(60):
        values = rng.integers(0, 9 if trial % 2 else 1 << 60, rng.integers(1, 150)).astype(np.uint64)
        span = int(rng.integers(2, 20))
        want = []
        for c in np.flatnonzero(values):
            begin = end = int(c)
            while begin and values[begin - 1] >= values[c]:
                begin -= 1
            while end + 1 < len(values) and values[end + 1] >= values[c]:
                end += 1
            if end - begin + 1 >= span:
                want.append((begin, int(c), end))
        got = substring_dedup.compact_windows(values, span)
        assert list(zip(*(x.tolist() for x in got))) == want


def test_substring_dedup_finds_every_long_repeat_and_leaves_the_rest(spark, prose):
    rows = [r for r in prose if r[0] is not None]
    found = substring_dedup.passages(clashing(frame(spark, rows))).collect()
    words = {(d, t): re.findall(ITEM_WORDS, ascii_lower(t)) for d, t in rows}
    holders = defaultdict(set)
    for key, w in words.items():
        for i in range(len(w) - 49):
            holders[tuple(w[i : i + 50])].add(key)
    covered, reported = defaultdict(set), defaultdict(set)
    for key, w in words.items():
        for i in range(len(w) - 49):
            if len(holders[tuple(w[i : i + 50])]) > 1:
                covered[key[0]].update(range(i, i + 50))
    for r in found:
        reported[r.doc_id].update(range(r.first_word, r.last_word + 1))
    want, got = sum(map(len, covered.values())), sum(len(c & reported[d]) for d, c in covered.items())
    assert set(covered) <= set(reported) and got >= 0.99 * want
    near = {d for d, t in rows if t and "edited" in t}
    assert set(reported) <= set(covered) | near
    by_passage = defaultdict(set)
    for r in found:
        by_passage[r.passage_id].add((r.keeper_doc_id, r.doc_id == r.keeper_doc_id or r.repeated))
    assert all(len({k for k, _ in v}) == 1 and all(ok for _, ok in v) for v in by_passage.values())


def hot_boilerplate(pairs=40, seed=7):
    """Pairs of texts that share 55 words of their own, all around the same 47 words; and texts with those words alone."""
    rng = np.random.default_rng(seed)
    say = lambda k: [f"w{x}" for x in rng.integers(0, 1 << 40, k)]
    hot, rows = say(47), []
    for pair in range(pairs):
        left = int(rng.integers(0, 9))
        passage = say(left) + hot + say(8 - left)
        rows += [(2 * pair + i, " ".join(say(100) + passage + say(100))) for i in range(2)]
    return rows + [(1000 + i, " ".join(say(100) + hot + say(100))) for i in range(pairs)]


def test_substring_dedup_finds_pairs_around_a_hot_passage(spark):
    rows = hot_boilerplate()
    found = substring_dedup.passages(frame(spark, rows)).collect()
    passage = {r.doc_id: r.passage_id for r in found}
    linked = sum(2 * i in passage and passage[2 * i] == passage.get(2 * i + 1) for i in range(40))
    assert linked >= 38 and max(passage) < 1000


def test_substring_dedup_keeps_no_window_for_each_place_of_one_word():
    texts = pa.array(["the " * 3000, "x y z " + "the " * 200 + "x y z"])
    _, _, found = substring_dedup.windows_of_column(texts, 5, 46, 4)
    assert 4 * 180 < len(found["key"]) < 4 * 260
    other = np.random.default_rng(3).integers(1, 1 << 60, 4000).astype(np.uint64)
    begin, place, _ = substring_dedup.compact_windows(other, 46)
    assert len(substring_dedup.thinned(other[place], begin, place)) == len(place)


def brute_candidates(rows, span, enough):
    low, high, shift = rows[:, 1] + rows[:, 3], rows[:, 1] + rows[:, 4], rows[:, 1] - rows[:, 2]
    near = np.minimum(high[:, None], high) - np.maximum(low[:, None], low) + 1 >= span - substring_dedup.SHIFT
    near &= np.abs(shift[:, None] - shift) <= substring_dedup.SHIFT
    return sum(near[:, rows[:, 0] == f].any(axis=1) for f in set(rows[:, 0].tolist())) >= enough


def test_interval_join_is_that_of_all_pairs():
    rng = np.random.default_rng(2)
    for trial in range(200):
        n = int(rng.integers(1, 60))
        place = rng.integers(0, 2000, n)
        rows = np.stack([rng.integers(0, 4, n), place, place - 100 * rng.integers(0, 3, n), -rng.integers(0, 46, n), rng.integers(45, 90, n)], axis=1)
        got = substring_dedup.candidate_rows(rows, 46, 2)
        assert got.tolist() == rows[brute_candidates(rows, 46, 2)].tolist()


def test_open_windows_are_connected_without_all_their_pairs():
    rng = np.random.default_rng(4)
    say = lambda k: rng.integers(1, 1 << 32, k, dtype=np.uint32)
    line, whole = say(20), say(91)
    rows = []
    for text in range(90):  # 30 hold one passage, 60 no more than a line
        around = whole if text % 3 == 0 else np.concatenate([say(35), line, say(36)])
        rows.append((0, False, True, text, 0, 45, 0, 90, around.tobytes(), 0))
    pairs = substring_dedup.connecting_meets(rows, 46, 75)
    assert len(pairs) == 29 and {x for pair in pairs for x in pair} == set(range(0, 90, 3))
    dealt = [(k % 2, *row[1:]) for k, row in enumerate(rows)]  # two parts: only across
    assert all((a - b) % 2 for a, b in substring_dedup.connecting_meets(dealt, 46, 75))


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.passages(frame(spark, [])).collect() == []
    assert substring_dedup.passages(frame(spark, [(1, None), (2, ""), (3, "short")])).collect() == []
