"""Token counts and files, quality rules, mixing, URL filters and sharding."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from bankspark.llm import mixing, quality_rules, sharding, token_counts, token_files, url_filter, words
from tests.llm.conftest import ascii_lower, blank_words, clashing, frame


@pytest.mark.parametrize("is_word, lower, pattern", [
    (words.NOT_BLANK, False, r"[^\x20\x09-\x0D]+"), (words.ALPHANUMERIC, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
])
def test_words_are_those_of_the_pattern(prose, is_word, lower, pattern, monkeypatch):
    monkeypatch.setattr(words, "PIECE_BYTES", 50)
    texts = [t for _, t in prose]
    found = words.words_of(pa.array(texts), is_word, lower)
    want = [re.findall(pattern, ascii_lower(t) if lower else t or "") for t in texts]
    data = found.data.tobytes()
    got = [data[a:b].decode() for a, b in zip(found.starts, found.ends)]
    assert got == [w for ws in want for w in ws] and found.counts.tolist() == list(map(len, want))
    hashes = found.hashes()
    assert len(set(zip(got, hashes.tolist()))) == len(set(got)) == len(set(hashes.tolist()))


ODD = [
    "", " ", "  lead", "trail  ", "a\n\n  b\t\tc   d", "don't they'll --'s x's 'S", "12ab34 $$% (foo) 'x'", "á b İ ΣΑΣ", "áb ,́",
    "<|endoftext|>  hi <|startoftext|>y<|ENDOFTEXT|>", "x  y　z  w\x85", "\x1c\x1d a\x1fb", "\r\n\r\n x\x0b\x0cy", "日本語 テスト", "ñÿ×÷é, é!",
]


def test_token_counts_are_the_librarys(spark, prose):
    rows = prose + [(1000 + i, t) for i, t in enumerate(ODD)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(
        ((d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False)), n > 512) for d, t in rows), key=repr
    )
    got = token_counts.op5_token_counts(clashing(frame(spark, rows)))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert token_counts.op5_token_counts(frame(spark, [])).collect() == []


def test_proven_tokens_encode_alone():
    tokenizer_json = token_counts.vocabulary_json(public_tokenizers.path("byte_bpe_50k.json"))
    proven = token_counts.proven_tokens(tokenizer_json)
    library = Tokenizer.from_str(tokenizer_json)
    assert len(proven) > 45_000 and len(set(proven)) == len(proven)
    assert all(len(e) == 1 for e in library.encode_batch(proven[::97], add_special_tokens=False))


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 1000])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    ends, payload = token_files.pack(ids, block=64, bits=bits)
    assert token_files.unpack(payload, ends, n, block=64, bits=bits).tolist() == ids.tolist()


def test_token_files_hold_the_librarys_ids(spark, prose, monkeypatch):
    rows = [(None if d is None else d * 3, t) for d, t in prose if d is not None] + [(2000 + i, t) for i, t in enumerate(ODD)]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for r in token_files.op2_token_files(clashing(frame(spark, rows))).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    start, want = 0, defaultdict(set)
    encoded = defaultdict(list)
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        encoded[d].append((len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    for d in sorted(encoded):
        places = sorted(got[d])
        assert sorted(p[1:] for p in places) == sorted(encoded[d])
        for at, n, _ in places:
            assert at == start
            start += n
    assert token_files.op2_token_files(frame(spark, [])).collect() == []
    assert token_files.op2_token_files(frame(spark, [(None, None), (4, "hi")])).orderBy("start").first().doc_id == 4


def brute_measures(text):
    w, lines, seen, again = blank_words(text), (text or "").split("\n"), set(), 0
    for line in lines:
        if blank_words(line):
            again += line in seen
            seen.add(line)
    places = defaultdict(list)
    for i in range(len(w) - 4):
        places[tuple(w[i : i + 5])].append(i)
    repeated = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(repeated)


def test_quality_counts_and_verdicts(spark, prose):
    rng = np.random.default_rng(3)
    common = "the of and to in is was for it with".split()
    good = [" ".join(rng.choice(common) if rng.random() < 0.4 else f"word{rng.integers(500)}" for _ in range(150)) for _ in range(60)]
    junk = [" ".join(f"{w}{s * 3}" for w, s in zip(t.split(), "%#$&" * 40)) for t in good[:3]]
    rows = [(*r, "zz") for r in prose] + [(5000 + i, t) for i, t in enumerate(good)] + [(6000 + i, t) for i, t in enumerate(junk)]
    rows += [(7000, good[0], None, None), (7002, good[1], None, None), (7001, "Dies ist " * 3, "xx", "b")]
    docs = clashing(frame(spark, rows))
    got = quality_rules.op4_quality_rules(docs).collect()
    want = sorted(((r[0], *brute_measures(r[1])) for r in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=repr) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[5000 + i] for i in range(60)) and not any(kept[6000 + i] for i in range(3)) and kept[7000]
    stays = quality_rules.kept_documents(docs)
    assert stays.columns == docs.columns and stays.count() == sum(r.kept for r in got)
    assert quality_rules.op4_quality_rules(frame(spark, [])).collect() == []


def brute_targets(sizes, weights, share=1.5, epochs=2.0):
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in sizes if s not in full]
        room = total - sum(epochs * sizes[s] for s in full)
        level = room / sum(weights[s] for s in rest) if rest else 0
        more = {s for s in rest if weights[s] * level > epochs * sizes[s]}
        if not more:
            return {s: epochs * sizes[s] if s in full else weights[s] * level for s in sizes}
        full |= more


def test_mixing_meets_its_targets(spark, prose):
    rng = np.random.default_rng(1)
    sources = ["b", "a", None, "Z", "é", "a "]
    rows = [(d, t, "en", sources[i % 5]) for i, (d, t) in enumerate(prose)]
    rows += [(3000 + i, "w " * int(rng.integers(1, 60)), "en", sources[int(rng.integers(0, 6))]) for i in range(600)]
    docs = clashing(frame(spark, rows))
    got = mixing.op6_mixing(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.op6_mixing(docs.repartition(5)).collect()), key=repr)
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(blank_words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    targets = brute_targets(sizes, weights)
    name, taken, most = {r[0]: r[3] for r in rows}, defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    by_total = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_total[r.source_size] = r.target
        if r.doc_id is not None and r.doc_id >= 3000:
            s = name[r.doc_id]
            assert r.target == pytest.approx(targets[s]) and r.source_size == sizes[s]
    for r in got:
        taken[r.source_size] += r.taken
        most[r.source_size] = max(most[r.source_size], r.size)
    for total, words_taken in taken.items():
        assert abs(words_taken - by_total[total]) <= most[total]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(blank_words(r.text)) for r in mixed.select("text").collect()) == sum(r.taken for r in got)
    assert mixing.op6_mixing(frame(spark, [])).collect() == []
    assert [r.taken for r in mixing.op6_mixing(frame(spark, [(1, None), (2, "")])).collect()] == [0, 0]


def test_mixing_cuts_on_the_edge_of_a_cell(spark):
    ten = [(i, "w " * 100, "en", "a") for i in range(10)]
    assert sorted(r.taken for r in mixing.op6_mixing(frame(spark, ten)).collect()) == [100] * 5 + [200] * 5
    assert mixing.mixed_documents(frame(spark, ten)).count() == 15
    # Documents of 10 words in cells of the first round, of the second, and in one cell of both.
    hashes = sorted((a << 48) + (b << 36) + c for a, b, c in [(0, 0, 1), (0, 0, 9), (0, 7, 0), (5, 0, 0), (5, 4095, 3), (4095, 1, 1)])
    targets = [(str(t), 60, float(t)) for t in range(0, 121, 5)]
    sized = spark.createDataFrame([(k, h, 10) for k, *_ in targets for h in hashes], "source_key string, hash long, size long")
    planned = mixing.cuts(sized, spark.createDataFrame(targets, "source_key string, source_size long, target double")).collect()
    assert len(planned) == len(targets)
    for r in planned:
        whole, want = divmod(int(r.target), 60)
        more = [want > 0 and 2 * 10 * i + 10 <= 2 * want for i in range(6)]
        assert r.whole == whole and [h <= r.limit for h in hashes] == more, r


PAGES = [
    (1, "http://www.Example.com/en/1?x=1"), (2, "https://sub.www.example.com/en/"), (3, "http://a.example.com/en/x#t"), (4, "http://com/"),
    (5, "http://x.net/es/9"), (6, "http://x.net/fr"), (7, "http://notexample.com/en/"), (8, "http://example.com"), (9, None), (10, "no scheme"),
    (11, "http://bad.org/a"), (12, "http://bad.org/b"), (13, "http://fine.org/a"), (13, "http://fine.org/a"), (14, "://"),
]


def test_url_rules_and_reputation(spark):
    pages = [*PAGES, *((100 + i, f"http://bad.org/{i}") for i in range(40)), *((200 + i, f"http://fine.org/{i}") for i in range(40))]
    labels = [(100 + i, 0, 1) for i in range(38)] + [(200 + i, 1, 0) for i in range(38)] + [(None, None, None), (200, None, 1)]
    docs = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS n", "2 AS a")
    judged = url_filter.op7_url_filter(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged}
    assert len(judged) == len(pages)
    assert got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and got[2][2:] == ("www.example.com/en/", "allow")
    assert got[3][2:] == ("example.com/en/", "block") and got[4][2:] == ("com/", "allow") and got[5][2:] == ("net/es/", "block")
    assert got[6] == ("x.net", "/fr", None, "allow") and got[7][2:] == ("com/", "allow") and got[8] == ("example.com", "", None, "allow")
    assert got[9][:2] == got[10][:2] == got[14][:2] == ("", "")
    assert got[11][3] == "block" and got[139][3] == "block" and got[13][3] == got[239][3] == "allow"
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.verdict for r in url_filter.op7_url_filter(spark.createDataFrame([(1, "http://q.org/")], "page_id long, url string"), none).collect()} == {"allow"}
    assert url_filter.op7_url_filter(spark.createDataFrame([], "page_id long, url string"), none).collect() == []


def test_domains_and_suffixes(spark):
    hosts = [("a.b.co.uk", "b.co.uk", "co.uk"), ("u@x.example.com:80", "example.com", "com"), ("com", "com", "com"), ("", "", "")]
    df = spark.createDataFrame([(h,) for h, _, _ in hosts], "host string")
    domain, suffix = url_filter.domain_of(df["host"])
    assert [tuple(r) for r in df.select("host", domain, suffix).collect()] == hosts


SUFFIX_LIST = """
// names below which anyone registers
com
co.uk   two labels
*.ck
!www.ck
kobe.jp
*.Kobe.jp
!city.kobe.jp
"""


def brute_domain(host, rules):
    """The public suffix algorithm, rule by rule."""
    labels = host.split(".")
    best, length = 0, 1
    for rule in rules:
        parts = rule.removeprefix("!").split(".")
        if len(parts) <= len(labels) and all(p in ("*", x) for p, x in zip(reversed(parts), reversed(labels))):
            if rule.startswith("!"):
                best, length = 99, len(parts) - 1
            elif len(parts) > best:
                best, length = len(parts), len(parts)
    return ".".join(labels[-length - 1 :]), ".".join(labels[-length:])


def test_suffix_rules_with_wildcards_and_exceptions(spark):
    rules = url_filter.suffix_rules(SUFFIX_LIST.splitlines())
    assert rules == ("com", "co.uk", "*.ck", "!www.ck", "kobe.jp", "*.kobe.jp", "!city.kobe.jp")
    tails = ["com", "a.com", "co.uk", "uk", "ck", "x.ck", "www.ck", "jp", "kobe.jp", "c.kobe.jp", "city.kobe.jp", "nowhere"]
    hosts = [f"{front}{t}" for t in tails for front in ("", "a.", "b.a.", "d.b.a.")]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain, suffix = url_filter.domain_of(df["host"], rules)
    for r in df.select("host", domain.alias("domain"), suffix.alias("suffix")).collect():
        assert (r.domain, r.suffix) == brute_domain(r.host, rules), r
    assert [tuple(r) for r in df.limit(1).select(*url_filter.domain_of(df["host"], ())).collect()] == [("com", "com")]


def test_reputation_shrinks_within_the_suffix_it_is_given(spark):
    """Hosts without a label of their own under a bad registered domain go; with one more suffix rule they are strangers."""
    pages = [(i, f"http://h{i % 8}.bad.zone.org/{i}") for i in range(80)] + [(200 + i, f"http://g{i % 8}.fine{i % 8}.org/{i}") for i in range(80)]
    pages += [(500, "http://new.bad.zone.org/"), (501, "http://new.fine1.org/")]
    labels = spark.createDataFrame([(p, int(p >= 200), 0) for p, _ in pages if p < 500], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(pages, "page_id long, url string")
    said = {r.page_id: r.verdict for r in url_filter.judge(docs, labels, []).collect()}
    assert said[0] == "block" and said[500] == "block" and said[200] == said[501] == "allow"
    plan = url_filter.judge(docs, labels, [])._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan
    other = {r.page_id: r.verdict for r in url_filter.judge(docs, labels, [], long_suffixes=["*.zone.org"]).collect()}
    assert other[0] == "block" and other[501] == "allow"


def test_sharding_balances_bytes_by_editing_the_map(spark, prose):
    rows = prose + [(3000 + i, "x" * (i % 97)) for i in range(3000)]
    docs = clashing(frame(spark, rows))
    got = sharding.op9_sharding(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows if d is not None
    )
    loads, places = defaultdict(int), defaultdict(list)
    for r in got:
        loads[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert set(loads) == set(range(24)) and all(sorted(p) == list(range(len(p))) for p in places.values())
    largest = max(r.size for r in got)
    others = sorted(loads.values())[:-1]  # one document is larger than a shard's share
    assert max(loads.values()) <= largest + 500 and max(others) - min(others) <= 0.1 * max(others)
    stays = sharding.sharded_documents(docs)
    assert {r.doc_id: r.shard for r in stays.collect() if r.doc_id is not None} == {r.doc_id: r.shard for r in got if r.doc_id is not None}
    assert sharding.op9_sharding(frame(spark, [])).collect() == []


def test_rebalancing_moves_few_slots(spark):
    sums = spark.createDataFrame([(i, 100 + i % 7) for i in range(400)], "virtual_slot int, bytes long")
    first = sharding.first_map(spark, 8, 400)
    second = sharding.rebalanced(first, sums, 8)
    before = {r.virtual_slot: r.shard for r in first.collect()}
    after = {r.virtual_slot: r.shard for r in second.collect()}
    assert {r.version for r in second.collect()} == {1} and set(before) == set(after)
    assert sum(before[s] != after[s] for s in after) <= 40
    loads = defaultdict(int)
    for s, shard in after.items():
        loads[shard] += 100 + s % 7
    assert max(loads.values()) - min(loads.values()) <= 110
