"""The pipeline against a brute-force version of its stages, on a small corpus."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from bankspark.llm import quality_rules
from tests.llm.conftest import ascii_lower, blank_words, frame
from tests.llm.test_pairs import brute_components, brute_contamination
from tests.llm.test_rows import brute_measures, brute_targets

ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CLASSES = [
    "[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"""[.,;:!?'"()\-]""", r"[#$%&*+/<=>@\[\\\]^_`{|}~]", r"[\x00-\x08\x0E-\x1F\x7F]",
    "[\x80-\xff]", "[Ā-Ͽ]", "[Ѐ-߿]", "[ࠀ-￿]", "[\U00010000-\U0010ffff]",
]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    common = "the of and to in is was for it with".split()
    say = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(900)}x" for _ in range(n))
    items = [(i, say(30)) for i in range(4)]
    rows = []
    for i in range(90):
        rows.append((i, say(rng.randrange(60, 200)) + ".", "en", rng.choice(["a", "b", "c", None])))
    rows += [(100 + i, rows[i][1] + " tail", "en", "b") for i in range(12)]  # near copies
    rows += [(120 + i, rows[20][1], "en", "c") for i in range(6)]  # copies
    rows += [(140 + i, say(40) + " " + items[i][1] + " " + say(20), "en", "a") for i in range(4)]  # benchmark passages
    rows += [(150 + i, " ".join(w + "%&$" for w in say(120).split()), "en", "a") for i in range(5)]  # junk
    rows += [(160, None, "en", "a"), (161, "", "en", "a"), (162, "too short", "en", "a"), (163, "again " * 80, "en", "b"), rows[3]]
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def shares(counts):
    total = sum(counts.values())
    return {k: n / total for k, n in counts.items()} if total else {}


def distance(p, q):
    if not p or not q:
        return 0.0
    terms = 0.0
    for k in set(p) | set(q):
        a, b = p.get(k, 0.0), q.get(k, 0.0)
        terms += (a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0)
    return math.sqrt(max(terms / 2, 0))


def brute_quality(rows):
    seen = []
    for row in rows:
        n, *_, repeated = brute_measures(row[1])
        chars = Counter({k: len(re.findall(c, row[1] or "")) for k, c in enumerate(CLASSES)})
        said = Counter(w if w in quality_rules.COMMON_WORDS else "" for w in re.findall(ITEM_WORDS, ascii_lower(row[1])))
        seen.append((row, n, n < 10 or 100 * repeated > 20 * n, shares(chars), shares(said)))
    sums = [Counter(), Counter()]
    words = sum(n for _, n, failed, *_ in seen if not failed)
    for _, _, failed, *parts in seen:
        if not failed:
            for total, part in zip(sums, parts):
                total.update(part)
    chars, said = map(shares, sums)
    return [
        row for row, n, failed, c, w in seen
        if not failed and not (n >= 40 and words >= 2000 and (
            distance(c, chars) > 0.25 + 0.5 / math.sqrt(n) or distance(w, said) > 0.2 + 2 / math.sqrt(n)))
    ]


def brute_copies(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(blank_words(r[1]))
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    targets = brute_targets(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    copies = {}
    for source in sizes:
        whole = math.floor(targets[source] / sizes[source])
        want, upto = targets[source] - whole * sizes[source], 0
        digest = lambda r: int(hashlib.md5(f"7:{r[0]}".encode()).hexdigest()[:15], 16)
        for r in sorted((r for r in rows if r[3] == source), key=digest):
            size = len(blank_words(r[1]))
            copies[r[0]] = whole + (want > 0 and 2 * upto + size <= 2 * want)
            upto += size
    return copies


def test_stages_match_brute_force(spark, corpus):
    folder, rows, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, want = docs.columns, rows
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        path = f"{folder}/{name.replace(' ', '_')}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        got[name] = docs.collect()
        assert docs.columns[: len(columns)] == columns
    ids = lambda found: sorted(r[0] for r in found)
    want = brute_quality(rows)
    assert ids(got["quality rules"]) == ids(want)
    assert not {r[0] for r in want} & {150, 151, 152, 153, 154, 160, 161, 162, 163}
    want = list(dict.fromkeys(want))  # a wholly repeated row is one document
    keep = {d for d, _, c in brute_components([r[:2] for r in want]) if d == c}
    want = [r for r in want if r[0] in keep]
    assert ids(got["n-gram join"]) == ids(want) and len(want) == 90 + 4
    leaks = {d for d, *_, bad in brute_contamination([r[:2] for r in want], items) if bad}
    want = [r for r in want if r[0] not in leaks]
    assert ids(got["decontamination"]) == ids(want) and leaks == {140, 141, 142, 143}
    copies = brute_copies(want)
    assert Counter(r.doc_id for r in got["mixing"]) == Counter({d: n for d, n in copies.items() if n})
    loads, place = Counter(), {}
    for r in got["sharding"]:
        loads[r.shard] += len((r.text or "").encode()) + 8
        assert place.setdefault(r.doc_id, r.shard) == r.shard
    assert Counter(r.doc_id for r in got["sharding"]) == Counter(r.doc_id for r in got["mixing"]) and max(loads) < 24
    largest = max(Counter(r.doc_id for r in got["mixing"])[r.doc_id] * (len(r.text) + 8) for r in got["mixing"])
    assert max(loads.values()) - min(loads[s] for s in range(24)) <= 2 * largest


def test_run_is_the_stages(spark, corpus):
    folder, *_ = corpus
    assert corpus_pipeline.ORACLE_SQL is None
    result = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "text", "shard", "virtual_slot"} <= set(result.columns) and result.count() > 90
