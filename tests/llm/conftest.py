from __future__ import annotations

import re

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])


def frame(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *("en", "a")[len(r) - 2 :])[:4] + (None if r[1] is None else len(r[1]),) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def clashing(docs):
    """The documents with columns that are called like those the jobs use."""
    names = (
        "row_key row doc label size hash token node block copies copy whole limit source_key virtual_slot shard slot "
        "set_id shared frequent needed runs first last _0 _1 _text carry_0 text_key key n_words language windows"
    ).split()
    for name in names:
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="session")
def prose():
    """Texts with all that is odd: NULL, empty, blank, very long, repeated, near copies, shared passages."""
    import random

    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, lines = say(70), [say(8) + "." for _ in range(6)]
    base = say(120)
    words = base.split()
    near = [" ".join(w if rng.random() > 0.02 else "edited" for w in words) for _ in range(12)]
    texts = [None, "", " \n\t ", "One two", "One two", "one  TWO", say(5), base, base, *near]
    texts += [say(40) + " " + passage + "\n" + say(30) for _ in range(5)] + [passage.upper()]
    texts += [say(60) + "\n" + "\n".join(lines) + "\n" + say(20) for _ in range(4)] + ["\n".join(lines * 3)]
    texts += ["<|endoftext|> it's a test\x1c " + say(12), "日本語 テキスト " * 15, "the " * 300, say(30_000)]
    texts += [say(rng.randint(1, 200)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(7, base), (None, say(25)), (None, None), (3, "One two")]
