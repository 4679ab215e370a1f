import random

import pytest
from pyspark.sql import functions as F


@pytest.fixture()
def cases(spark):
    """Documents with nulls, blanks, a very long text, ties, repeated rows and
    columns whose names the operators use themselves."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, shared, other = prose(120), prose(70), prose(90)
    near = base.split(" ")
    near[60] = "changed"
    texts = [
        base,
        base.replace(" ", " \t\n", 3),
        " ".join(near),
        None,
        "",
        " \n ",
        "one two three",
        "one\ttwo three",
        prose(60) + " " + shared + " " + prose(40),
        shared + " " + prose(30),
        prose(20) + "\n" + shared,
        prose(20_000),
        other + " " + shared[:150],
        "ÄÖ ß <|endoftext|> 日本語 İ Σ",
        "Same line\nSame line\n\nSame line " + prose(12),
    ]
    rows = [(k, t, f"s{k % 3}" if k % 4 else None, "en", len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[0], (None, base, "s1", None, None), (None, None, None, None, None), (100, base, "s2", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    clash = ["id", "words", "digest", "key", "score", "kept", "a", "b", "part", "quota", "left", "block", "size", "seed"]
    return df.withColumns({c: F.lit("x") for c in clash})


@pytest.fixture()
def no_rows(cases):
    return cases.limit(0)
