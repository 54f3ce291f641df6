"""Document jobs: chunks, facts, parsed values, term statistics.

A document is one row (doc_id, text).  Chunking, wrapping and fact extraction
work inside that row with built-in functions, so they need no shuffle and no
Python, and every text is processed whole.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark.functions.text import amount_myr, rate_pct, tokens, words

WORDS_PER_CHUNK = 200
LINE_CHARS = 92
SEPARATOR = ":  "
# The section names of a disclosure sheet.
SECTIONS = (
    "Product Overview", "Key Product Features", "Eligibility", "Fees and Charges", "Key Risks", "Protection",
    "Important Notice",
)
HEADING_SHARE = 0.05  # of all sheets, that have a heading
# Every line gets a line feed in front; then blank lines go, and a heading gets
# a second line feed, which nothing else in the text has.
_BLANK_LINE = r"\n[ \t\r]*(?=\n|\z)"

RATE_LABEL = "Profit rate"


def docs_chunk_words(documents: DataFrame, size: int = WORDS_PER_CHUNK) -> DataFrame:
    """Chunks of ``size`` words, numbered from 0; the last one may be shorter.

    The chunks are built as one array and exploded once, so a long document is
    not copied into each of its chunks.
    """
    starts = F.sequence(F.lit(0), F.floor((F.size("words") - 1) / size).cast("int"))
    chunks = F.transform(
        starts, lambda i: F.array_join(F.slice("words", i * size + 1, F.lit(size)), " ")
    )
    return (
        documents.select("doc_id", words("text").alias("words"))
        .select("doc_id", F.posexplode(F.when(F.size("words") > 0, chunks)).alias("chunk_no", "text"))
        .select("doc_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), "text")
    )


def wrap_lines(text: Column | str, max_chars: int = LINE_CHARS) -> Column:
    """Greedy lines of at most ``max_chars``; a longer word stays whole on a line of its own."""
    one_line = F.array_join(words(text), " ")
    pattern = rf"(?s)([^ ]{{{max_chars + 1},}}|.{{1,{max_chars}}})(?: |\z)"
    return F.regexp_extract_all(one_line, F.lit(pattern), F.lit(1))


def docs_chunk_wrap(documents: DataFrame, max_chars: int = LINE_CHARS) -> DataFrame:
    """Wrapped lines of each document; a document without words gives one empty line."""
    lines = wrap_lines("text", max_chars)
    lines = F.when(F.size(lines) == 0, F.array(F.lit(""))).otherwise(lines)
    return documents.select("doc_id", F.posexplode(lines).alias("line_no", "line")).select(
        "doc_id", F.col("line_no").cast("bigint").alias("line_no"), "line"
    )


def docs_facts(sheets: DataFrame, sections: Sequence[str] = SECTIONS) -> DataFrame:
    """'label:  value' lines and paragraphs, each with the section it stands in.

    A line that is a section's name is a heading.  Any other line without the
    separator is a paragraph: its label is NULL and its value the line.  Blank
    lines are skipped; what stands before the first heading has a NULL section.
    Columns other than ``text`` are carried along.
    """
    keep = [c for c in sheets.columns if c != "text"]
    heading = rf"\n(?=(?:{'|'.join(map(re.escape, sections))})[ \t\r]*(?:\n|\z))"
    packed = F.regexp_replace(F.concat(F.lit("\n"), "text"), _BLANK_LINE, "")
    marked = F.regexp_replace(packed, heading, "\n\n")
    bodies = sheets.select(*keep, F.posexplode(F.split(marked, "\n\n")).alias("section_no", "body"))
    named = F.when(F.col("section_no") > 0, F.regexp_replace(F.substring_index("body", "\n", 1), r"[ \t\r]+\z", ""))
    rest = F.split("body", "\n")
    rest = F.when(F.col("section_no") > 0, F.slice(rest, 2, F.greatest(F.size(rest) - 1, F.lit(0)))).otherwise(rest)
    lines = bodies.select(*keep, named.alias("section"), F.explode(rest).alias("line")).filter("line != ''")
    at = F.instr("line", SEPARATOR)
    return lines.select(
        *keep,
        "section",
        F.when(at > 0, F.substring_index("line", SEPARATOR, 1)).alias("label"),
        F.when(at > 0, F.col("line").substr(at + len(SEPARATOR), F.length("line"))).otherwise(F.col("line")).alias("value"),
    )


def docs_headings(sheets: DataFrame, share: float = HEADING_SHARE) -> DataFrame:
    """(heading, sheets): lines that many sheets have and that introduce facts, told from the corpus itself.

    A heading has no separator, stands in at least ``share`` of all sheets (and in two), and in most of them the next
    line that is not blank is a fact.  One aggregate; a sheet counts a line once.
    """
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.regexp_replace(x, r"[ \t\r]+\z", ""))
    lines = F.filter(trimmed, lambda x: x != "")
    marked = F.transform("lines", lambda x, i: F.struct(
        x.alias("heading"), F.coalesce(F.contains(F.get("lines", i + 1), F.lit(SEPARATOR)), F.lit(False)).alias("leads")
    ))
    seen = sheets.filter("text IS NOT NULL").select(lines.alias("lines")).select(
        F.explode(F.array_distinct(F.filter(marked, lambda m: ~F.contains(m.heading, F.lit(SEPARATOR))))).alias("m"),
    )
    n = sheets.filter("text IS NOT NULL").count()
    return (
        seen.groupBy("m.heading")
        .agg(F.count_if("m.leads").alias("sheets"), F.count(F.lit(1)).alias("lines"))
        .filter((F.col("sheets") >= max(2, share * n)) & (2 * F.col("sheets") > F.col("lines")))
        .select("heading", "sheets")
    )


def docs_facts_found(sheets: DataFrame, share: float = HEADING_SHARE) -> DataFrame:
    """Facts under the headings that the corpus itself shows.

    A heading stands in ``share`` of the sheets, so there are at most the lines of a mean sheet divided by it.
    """
    headings = [row["heading"] for row in docs_headings(sheets, share).collect()]
    return docs_facts(sheets, sorted(headings, key=len, reverse=True) or ["\n"])


def docs_rate_parse(facts: DataFrame) -> DataFrame:
    return facts.withColumn("rate_pct", rate_pct("value"))


def docs_amount_parse(facts: DataFrame) -> DataFrame:
    return facts.withColumn("amount_myr", amount_myr("value"))


def docs_label_lookup(
    facts: DataFrame, product: str | None = None, section: str | None = None, label: str | None = None
) -> DataFrame:
    """Facts of a product, section or label: eligibility, concept, fees."""
    for column, wanted in (("product", product), ("section", section), ("label", label)):
        if wanted is not None:
            facts = facts.filter(F.col(column) == wanted)
    return facts


def docs_compare_products(facts: DataFrame, first: str, second: str) -> DataFrame:
    """Each label of two products side by side: what every sheet says, with the sheet as the citation.

    One row per label, value and sheet.  ``side`` is 'a' for the first product and 'b' for the second, and
    ``both_sides`` tells whether the other product's sheets have the label too.
    """
    side = F.when(F.col("product") == first, "a").otherwise("b")
    cited = facts.filter(F.col("product").isin(first, second) & F.col("label").isNotNull()).select(
        "label", side.alias("side"), "value", "doc_id"
    )
    known = cited.groupBy("label").agg((F.min("side") != F.max("side")).alias("both_sides"))
    return cited.join(known, "label")


def sheet_rates(facts: DataFrame, key: str = "product") -> DataFrame:
    """One profit rate per sheet; a sheet without the label, or without a rate in it, has NULL."""
    rate = F.max(F.when(F.col("label") == RATE_LABEL, rate_pct("value")))
    return facts.groupBy(key).agg(rate.alias("sheet_rate_pct"))


def docs_catalog_reconcile(catalog: DataFrame, sheets: DataFrame, key: str = "product") -> DataFrame:
    """The catalog (key, profit_rate_pct) against the sheets (key, sheet_rate_pct)."""
    left = catalog.select(key, "profit_rate_pct", F.lit(True).alias("in_catalog"))
    right = sheets.select(key, "sheet_rate_pct", F.lit(True).alias("in_sheets"))
    status = (
        F.when(F.col("in_sheets").isNull(), "missing sheet")
        .when(F.col("in_catalog").isNull(), "missing product")
        .when(F.col("sheet_rate_pct").isNull(), "no rate in sheet")
        .when(F.col("sheet_rate_pct") != F.col("profit_rate_pct"), "rate differs")
        .otherwise("match")
    )
    return left.join(right, key, "full_outer").select(
        key, "profit_rate_pct", "sheet_rate_pct", status.alias("status")
    )


def docs_term_stats(documents: DataFrame) -> DataFrame:
    """The index: (doc_id, term, tf, doc_len), each term of each document and its length in terms.

    A document is one row, so its terms are counted inside that row: they are
    sorted, and the distance between the starts of two runs is a term's count.
    No posting is shuffled.

    Document frequencies are a table of their own, see ``docs_document_frequency``:
    ranking needs them for the question's terms only, and joining them to every
    posting would move the whole index.
    """
    return term_postings(documents.select("doc_id", F.sort_array(tokens("text")).alias("terms")))


def term_postings(sorted_terms: DataFrame) -> DataFrame:
    """The same from documents as sorted arrays (doc_id, terms)."""
    runs = (
        sorted_terms.withColumn("n", F.size("terms"))
        .withColumn("starts", F.when(F.col("n") > 0, F.filter(
            F.sequence(F.lit(0), F.col("n") - 1),
            lambda i: (i == 0) | (F.get("terms", i) != F.get("terms", i - 1)),
        )))
    )
    postings = F.transform("starts", lambda start, run: F.struct(
        F.get("terms", start).alias("term"),
        (F.coalesce(F.get("starts", run + 1), F.col("n")) - start).cast("bigint").alias("tf"),
    ))
    return runs.select("doc_id", F.col("n").cast("bigint").alias("doc_len"), F.inline(postings)).select(
        "doc_id", "term", "tf", "doc_len"
    )


def docs_document_frequency(documents: DataFrame) -> DataFrame:
    """(term, df): the number of documents that contain the term."""
    return (
        documents.select(F.explode(F.array_distinct(tokens("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
