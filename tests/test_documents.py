from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from bankspark import schemas as S
from bankspark.operators import documents as D
from bankspark.operators import fusion, retrieval, routing, search
from bankspark.sources.scratch import store

QUIET = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXT = st.text(alphabet="abé €\n\tXY,.:\u0085\u2028\u2029\u00a0", max_size=300)

# The twelve disclosure sheets and the profit rate line of each.
SHEETS = [
    ("Personal Financing-i", "4.50% per annum (fixed) on a flat-rate basis"),
    ("Home Financing-i", "3.85% per annum (variable, benchmarked to base rate)"),
    ("Vehicle Financing-i", "3.40% per annum (fixed, flat rate)"),
    ("Education Financing-i", "3.75% per annum (fixed)"),
    ("Micro Financing-i", "6.00% per annum"),
    ("Cash Line-i", "7.50% per annum on utilised amount"),
    ("Credit Bills Financing-i", "5.25% per annum"),
    ("Term Deposit-i", "Up to 3.85% per annum for 12-month tenure"),
    ("Savings-i Account", "0.25% per annum on daily balance"),
    ("Credit Card-i", None),
    ("Investment-i Fund", None),
    ("Takaful Protection-i", None),
]


@pytest.fixture(scope="module")
def sheets(spark):
    rows = []
    for number, (title, rate) in enumerate(SHEETS):
        lines = ["Product Disclosure Sheet", title, "", "Key Product Features"]
        lines += [f"Profit rate:  {rate}"] if rate else ["Management fee:  Up to 15% per annum"]
        lines += ["Eligibility", "Age:  21 to 60 years old", "A paragraph: with one blank.", "Fees and Charges"]
        lines += ["Late payment charge:  1% per annum on overdue amount"]
        rows.append((number, title, "\n".join(lines)))
    return spark.createDataFrame(rows, "doc_id bigint, product string, text string")


def _docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@QUIET
@given(text=TEXT, size=st.integers(1, 7))
def test_chunks_hold_every_word_once(spark, text, size):
    chunks = D.docs_chunk_words(_docs(spark, text), size).orderBy("chunk_no").collect()
    words = [w for w in re.split(r"[ \t\n\r]+", text) if w]
    assert [c["chunk_no"] for c in chunks] == list(range(len(chunks)))
    assert [c["text"] for c in chunks] == [" ".join(words[i:i + size]) for i in range(0, len(words), size)]


def greedy(words, width):
    lines = []
    for word in words:
        if lines and len(lines[-1]) + 1 + len(word) <= width:
            lines[-1] += " " + word
        else:
            lines.append(word)
    return lines or [""]


@QUIET
@given(text=TEXT, width=st.integers(1, 12))
def test_wrapping_is_greedy(spark, text, width):
    lines = [r["line"] for r in D.docs_chunk_wrap(_docs(spark, text), width).orderBy("line_no").collect()]
    words = [w for w in re.split(r"[ \t\n\r]+", text) if w]
    assert lines == greedy(words, width)
    assert all(len(line) <= width or " " not in line for line in lines)


def test_long_text_is_processed_whole(spark):
    text = " ".join(f"w{i}" for i in range(120_000)) + " " + "x" * 100_000
    docs = _docs(spark, text)
    assert D.docs_chunk_words(docs).count() == math.ceil(120_001 / 200)
    lines = [r["line"] for r in D.docs_chunk_wrap(docs).orderBy("line_no").collect()]
    assert " ".join(lines) == text
    assert lines[-1] == "x" * 100_000
    long_line = "word " * 50_000 + "\nRate:  1% per annum"
    facts = D.docs_facts(_docs(spark, long_line)).collect()
    assert [(f["label"], f["value"]) for f in facts] == [(None, "word " * 50_000), ("Rate", "1% per annum")]


def test_facts(spark):
    docs = _docs(
        spark,
        "First:  no heading yet\nEligibility\nA:  1\n\nB:  2:  3\nno fact: one blank\nC:  4",
        "", "only a title", "Fees and Charges\nAll fees exclude tax.\nStamp duty:  0.5%", None,
    )
    rows = [tuple(r) for r in D.docs_facts(docs).collect()]
    assert sorted(rows, key=str) == sorted([
        (0, None, "First", "no heading yet"), (0, "Eligibility", "A", "1"), (0, "Eligibility", "B", "2:  3"),
        (0, "Eligibility", None, "no fact: one blank"), (0, "Eligibility", "C", "4"), (2, None, None, "only a title"),
        (3, "Fees and Charges", None, "All fees exclude tax."), (3, "Fees and Charges", "Stamp duty", "0.5%"),
    ], key=str)


LINES = st.lists(st.sampled_from(
    ["Key Risks", "Eligibility \t", "a:  1", "b: one blank", "", "  ", "\t", ":  ", "c:  2:  3", "\u0001x", "x\u2028Eligibility"]
), max_size=12)


@QUIET
@given(lines=LINES)
def test_facts_follow_the_line_rule(spark, lines):
    section, want = None, []
    for line in lines:
        if line.rstrip(" \t\r") in D.SECTIONS:
            section = line.rstrip(" \t\r")
        elif ":  " in line:
            want.append((section, *line.split(":  ", 1)))
        elif line.strip(" \t\r"):
            want.append((section, None, line))
    got = [(r["section"], r["label"], r["value"]) for r in D.docs_facts(_docs(spark, "\n".join(lines))).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_parsers(spark):
    df = spark.createDataFrame(
        [("4.50% per annum (fixed)",), ("~6% per annum",), ("RM1,000 initial, RM100 later",), ("RM12.50",), ("Nil",)],
        "value string")
    parsed = D.docs_amount_parse(D.docs_rate_parse(df)).collect()
    assert [r["rate_pct"] for r in parsed] == [4.5, 6.0, None, None, None]
    assert [r["amount_myr"] for r in parsed] == [None, None, 1000.0, 12.5, None]


def test_lookup_and_comparison(sheets):
    facts = D.docs_facts(sheets)
    fees = D.docs_label_lookup(facts, product="Home Financing-i", section="Fees and Charges").collect()
    assert [(r["doc_id"], r["label"]) for r in fees] == [(1, "Late payment charge")]
    compared = D.docs_compare_products(facts, "Personal Financing-i", "Home Financing-i")
    rate = {r["side"]: r for r in compared.filter("label = 'Profit rate'").collect()}
    assert (rate["a"]["doc_id"], rate["b"]["doc_id"]) == (0, 1)
    assert (rate["a"]["value"][:5], rate["b"]["value"][:5]) == ("4.50%", "3.85%")
    twice = facts.unionByName(facts.filter("doc_id = 0").selectExpr("70L AS doc_id", "product", "section", "label", "value"))
    cited = D.docs_compare_products(twice, "Personal Financing-i", "Credit Card-i").filter("label = 'Profit rate'").collect()
    assert [(r["doc_id"], r["both_sides"]) for r in sorted(cited, key=lambda r: r["doc_id"])] == [(0, False), (70, False)]


def test_catalog_and_sheets_do_not_line_up(spark, sheets):
    catalog = spark.createDataFrame(S.PRODUCT_ROWS, S.PRODUCTS).withColumnRenamed("product_name", "product")
    found = D.docs_catalog_reconcile(catalog, D.sheet_rates(D.docs_facts(sheets))).collect()
    status = {r["product"]: r["status"] for r in found}
    assert status.pop("Credit Bills Financing-i") == "missing product"
    assert status.pop("Current Account-i") == "missing sheet"
    for product in ("Credit Card-i", "Investment-i Fund", "Takaful Protection-i"):
        assert status.pop(product) == "no rate in sheet"
    assert set(status.values()) == {"match"} and len(status) == 8


def test_term_stats(spark):
    docs = _docs(spark, "Tea, tea and COFFEE", "coffee", "", None)
    stats = {(r["doc_id"], r["term"]): (r["tf"], r["doc_len"]) for r in D.docs_term_stats(docs).collect()}
    assert stats == {(0, "tea"): (2, 4), (0, "and"): (1, 4), (0, "coffee"): (1, 4), (1, "coffee"): (1, 1)}
    assert {tuple(r) for r in D.docs_document_frequency(docs).collect()} == {("tea", 1), ("and", 1), ("coffee", 2)}


def brute_bm25(docs, questions, k):
    split = {d: [t for t in re.split(r"[\W_]+", text.lower()) if t] for d, text in docs}
    mean = sum(map(len, split.values())) / len(split)
    out = []
    for q, text in questions:
        scored = []
        for d, terms in split.items():
            tf = Counter(terms)
            score = 0.0
            for t in {t for t in re.split(r"[\W_]+", text.lower()) if t}:
                df = sum(t in terms for terms in split.values())
                if tf[t]:
                    idf = math.log(1 + (len(split) - df + 0.5) / (df + 0.5))
                    score += idf * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(terms) / mean))
            if score > 0:
                scored.append((-round(score, 4), d))
        out += [(q, rank, d, -s) for rank, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("per_segment,per_block", [(512, 512), (16, 2), (1, 512)])
def test_bm25_matches_brute_force(spark, per_segment, per_block):
    rng = np.random.default_rng(3)
    vocabulary = [f"t{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 60)))) for i in range(200)]
    docs += [(200 + i, "t1 t2 t3") for i in range(100)]  # a third are copies: ties go to the lower id
    questions = [(i, " ".join(rng.choice(vocabulary, 4))) for i in range(12)] + [(12, "unknown words")]
    corpus = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame(questions, "question_id bigint, text string")
    # Two indexes put together: their weights are for different reference lengths.
    index = search.word_index(corpus.filter("doc_id < 150"), per_segment).union(search.word_index(corpus.filter("doc_id >= 150"), per_segment))
    got = search.search_words(store(index), asked, 5, per_block=per_block).collect()
    assert sorted(tuple(r) for r in got) == brute_bm25(docs, questions, 5)
    named = corpus.selectExpr("concat('d', lpad(doc_id, 4, '0')) AS doc_id", "text")
    by_name = retrieval.docs_bm25_topk(named, asked, 5).collect()
    assert sorted((q, r, int(d[1:]), s) for q, r, d, s in by_name) == brute_bm25(docs, questions, 5)


def test_bm25_reads_little_for_telling_words(spark):
    """Documents that a few telling words single out: the postings of common words are left alone."""
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 80) if x < 500)) for i in range(1500)]
    docs += [(1500 + i, "amber basalt cobalt dune " * 3 + "w1 w2") for i in range(30)]
    questions = [(1, "amber basalt cobalt dune w1 w2 w3 w4 w5 w6")]
    corpus = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    report = Observation()
    got = retrieval.docs_bm25_topk(corpus, spark.createDataFrame(questions, "question_id bigint, text string"), 5, report)
    assert sorted(tuple(r) for r in got.collect()) == brute_bm25(docs, questions, 5)
    assert report.get["n_read"] < 0.4 * report.get["n_asked"]


def test_long_documents_make_small_segments(spark, monkeypatch):
    monkeypatch.setattr(search, "WORDS_PER_SEGMENT", 100)
    corpus = _docs(spark, *["tea milk " * 20] * 7, "tea " * 500, "", None).coalesce(1)
    segments = search.word_index(corpus).select("docs", "lengths").collect()
    assert sorted(d for s in segments for d in s["docs"]) == list(range(10))
    assert all(sum(s["lengths"]) <= 100 or len(s["docs"]) == 1 for s in segments) and len(segments) < 10


def test_what_a_search_task_holds_is_bounded(spark, monkeypatch):
    """Spark hands the rows of a task to Python at once, so the bytes of a task are bounded, whatever the index has."""
    corpus = _docs(spark, *[f"tea cup{i} " * 30 for i in range(400)]).coalesce(1)
    asked = spark.createDataFrame([(1, "tea cup7")], "question_id bigint, text string")
    index = search.store_index(search.word_index(corpus, 4))
    whole = search.search_words(index, asked, 3).collect()
    monkeypatch.setattr(search, "TASK_BYTES", 2000)
    cut = search.search_words(index, asked, 3)
    assert sorted(cut.collect()) == sorted(whole)
    entries = asked.selectExpr("question_id", "text AS term", "1D AS idf")
    pairs = search._meet(index, F.lit(200), entries, F.struct("question_id", "term", "idf"), F.lit(32), 512)
    held = pairs.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 100 and max(r["count"] for r in held) <= 2000 // (200 + 32) + 1
    files = [f.removeprefix("file://") for f in index.inputFiles()]
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert all(m.row_group(g).num_rows <= search.ROWS_PER_GROUP for m in groups for g in range(m.num_row_groups))


def test_search_tasks_grow_with_the_index_and_the_questions():
    task = search.TASK_BYTES
    assert search.tasks_for(0, 0, 0, 1, 8) == 1
    assert search.tasks_for(100 * task, 1000, 0, 1, 8) == 100
    assert search.tasks_for(100 * task, 1000, task // 10, 3, 8) == 400
    assert search.tasks_for(task, 10, 0, 1, 8) == 8


def test_bm25_without_answers(spark):
    asked = spark.createDataFrame([(1, "tea")], "question_id bigint, text string")
    assert retrieval.docs_bm25_topk(_docs(spark, "", None), asked).count() == 0
    assert retrieval.docs_bm25_topk(_docs(spark, "tea"), asked.filter("question_id > 5")).count() == 0


@pytest.mark.parametrize("per_block,pivots,per_cell", [(512, 64, 2048), (2, 5, 7), (512, 1, 1)])
def test_cosine_matches_brute_force(spark, per_block, pivots, per_cell):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 8))
    vectors[200:] = vectors[7]  # a third are copies
    vectors[3] = 0
    asked = rng.normal(size=(9, 8))
    docs = spark.createDataFrame(
        [*((i, v.tolist()) for i, v in enumerate(vectors)), (300, None)], "doc_id bigint, embedding array<float>",
    ).repartition(4)
    questions = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(asked)], "question_id bigint, embedding array<double>")
    got = search.search_vectors(store(search.vector_index(docs, pivots, per_cell)), questions, 4, per_block=per_block).collect()
    stored = vectors.astype(np.float32).astype(np.float64)
    length = np.linalg.norm(stored, axis=1)
    similar = np.round((stored @ asked.T) / np.outer(np.where(length > 0, length, 1), np.linalg.norm(asked, axis=1)), 6)
    want = [
        (q, rank, d, -s)
        for q in range(9)
        for rank, (s, d) in enumerate(sorted((-similar[d, q], d) for d in range(300))[:4], 1)
    ]
    assert sorted(tuple(r) for r in got) == want
    named = docs.selectExpr("concat('v', lpad(doc_id, 4, '0')) AS doc_id", "embedding")
    by_name = retrieval.docs_cosine_topk(named, questions.selectExpr("concat('q', question_id) AS question_id", "embedding"), 4)
    assert sorted((int(q[1:]), r, int(d[1:]), s) for q, r, d, s in by_name.collect()) == want


def test_cosine_leaves_out_far_cells(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 16))
    vectors = [(i, (centres[i % 20] + rng.normal(0, 0.05, 16)).tolist()) for i in range(2000)]
    docs = spark.createDataFrame(vectors, "doc_id bigint, embedding array<double>").repartition(2)
    asked = spark.createDataFrame([(q, centres[q].tolist()) for q in range(20)], "question_id bigint, embedding array<double>")
    report = Observation()
    got = retrieval.docs_cosine_topk(docs, asked, 3, report).collect()
    assert len(got) == 60 and all(r["doc_id"] % 20 == r["question_id"] for r in got)
    assert report.get["n_read"] < 0.3 * report.get["n_asked"]


def test_cosine_without_answers(spark):
    none = spark.createDataFrame([(1, None)], "doc_id bigint, embedding array<float>")
    some = spark.createDataFrame([(1, [1.0, 0.0])], "doc_id bigint, embedding array<float>")
    ask = lambda df: df.withColumnRenamed("doc_id", "question_id")
    assert retrieval.docs_cosine_topk(none, ask(some)).count() == 0
    assert retrieval.docs_cosine_topk(some, ask(none)).count() == 0


DESCRIPTIONS = [
    ("data", "counts of customers, spend and balance by segment, state and product holdings"),
    ("product", "profit rate, fees and eligibility requirements of financing and deposit products"),
]


def test_routing(spark):
    terms = routing.described_terms(
        spark.createDataFrame(DESCRIPTIONS, "specialist string, description string"))
    questions = spark.createDataFrame([
        (1, "How many customers live in that state?"),
        (2, "Tell me the profit rate for financing a home"),
        (3, "Which segment has the least spend, and what are the eligibility requirements for financing?"),
        (4, "zzz"),
    ], "id int, text string")
    scored = {(r["id"], r["specialist"]): r["score"] for r in routing.overlaps(questions, terms).collect()}
    assert scored[(1, "data")] == 2 and scored[(2, "product")] == 3
    best = {r["id"]: r["specialist"] for r in routing.route_questions(questions, terms).collect()}
    assert best == {1: "data", 2: "product", 3: "product", 4: "none"}
    both = {r["id"]: r["specialists"] for r in routing.route_multi(questions, terms, at_least=2).collect()}
    assert both == {1: "data", 2: "product", 3: "data,product", 4: "none"}
    counts = {r["id"]: r["n_specialists"] for r in routing.route_multi(questions, terms, at_least=9).collect()}
    assert counts == {1: 1, 2: 1, 3: 1, 4: 0}


def test_equal_scores_go_to_the_first_name(spark):
    terms = spark.createDataFrame([("b", "tea"), ("a", "tea")], "specialist string, term string")
    questions = spark.createDataFrame([(1, "tea")], "id int, text string")
    assert routing.route_questions(questions, terms).first()["specialist"] == "a"


def test_headings_are_told_from_the_corpus(spark):
    body = "Sheet {i}\nTakaful Cover  \n\nPlan:  basic\nNote to all\nFees\r\nCharge:  RM{i}\nNote to all"
    texts = [body.format(i=i) for i in range(20)] + ["Fees\nno fact here", None, "", "Rare One\nX:  1"]
    docs = _docs(spark, *texts)
    assert {tuple(r) for r in D.docs_headings(docs).collect()} == {("Takaful Cover", 20), ("Fees", 20)}
    facts = D.docs_facts_found(docs).filter("doc_id = 3").select("section", "label", "value").collect()
    assert [tuple(r) for r in facts] == [
        (None, None, "Sheet 3"), ("Takaful Cover", "Plan", "basic"), ("Takaful Cover", None, "Note to all"),
        ("Fees", "Charge", "RM3"), ("Fees", None, "Note to all"),
    ]
    assert D.docs_facts_found(_docs(spark, "plain", None)).collect()[0]["section"] is None


def test_fused_ranks(spark):
    ranking = lambda *rows: spark.createDataFrame(list(rows), "question_id bigint, rank bigint, doc_id string")
    fused = fusion.fuse([ranking((1, 1, "a"), (1, 2, "b")), ranking((1, 1, "b"), (2, 3, "a"))])
    assert {(r["question_id"], r["doc_id"]): r["score"] for r in fused.collect()} == {
        (1, "a"): round(1 / 61, 8), (1, "b"): round(1 / 62 + 1 / 61, 8), (2, "a"): round(1 / 63, 8)}


def test_one_chunk_of_a_neighbourhood_is_cited(spark):
    filler = [" ".join(f"w{i}x{j}" for j in range(199)) for i in range(6)]
    long = " ".join(f"{f} amber" for f in filler)  # six chunks, each with the word
    docs = _docs(spark, long, "amber", "cobalt", "", None)
    asked = spark.createDataFrame([(1, "amber")], "question_id bigint, text string")
    cited = [(r["doc_id"], r["chunk_no"]) for r in fusion.docs_cited_chunks(docs, asked).orderBy("rank").collect()]
    assert cited[0] == (1, 0)
    assert len({(d, c // 3) for d, c in cited}) == len(cited) and {d for d, _ in cited} == {0, 1, 2}
