import random

import pytest

EDGE_TEXTS = [
    None, "", "  \n\t", "one", "One", "one two", "one\x0btwo", "x" * 3000, "wörter über straße ñandú, ça.", "日本語 テスト 🙂 é",
    "a\x1cb\x85c\xa0d e", "I'll don't we've 12 3½", "tab\tline\r\nend ",
]


@pytest.fixture(scope="session")
def documents(spark):
    """Small tables of documents: (doc_id, text, lang, source, n_chars) rows, with whatever edge cases are asked for."""

    def make(rows):
        full = [(doc, text, "en", "src0", None if text is None else len(text)) for doc, text in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(7)
    long = " ".join(rng.choice(["the", "of", "alpha", "beta", "gamma", "delta"]) + str(rng.randrange(300)) for _ in range(20_000))
    rows = [(i, text) for i, text in enumerate(EDGE_TEXTS)]
    rows += [(100, long), (101, long), (None, "null id"), (None, None), (3, "one"), (3, "one"), (102, "another text of the id"), (102, "another text")]
    return documents(rows)


@pytest.fixture(scope="session")
def clashing(spark):
    """Extra columns whose names clash with the inputs and outputs of the operators, in other letters."""
    names = "doc_id long, Text string, text string, lang string, N_TOKENS long, n_words int, id string, kept string, row long, hash long, block int"
    return spark.createDataFrame([(1, "wrong", "right words here", "en", 5, 6, "x", "y", 7, 8, 9), (2, "wrong", None, None, 5, 6, "x", "y", 7, 8, 9)], names)


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
