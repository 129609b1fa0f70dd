"""Fill-in-the-middle texts against regular expressions, and the way back."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketrank.llm import fim

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def brute(doc, text, seed=1, plain=10, suffix_first=20):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 100 - plain:
        return (len(units), "plain", None, None, text)
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < suffix_first:
        return (len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def long_texts():
    rng = random.Random(9)
    paragraph = " ".join(rng.choice(["alpha", "Été", "x1", "日本", "…", "don't"]) + "abc"[: rng.randrange(3)] for _ in range(900))
    return [paragraph, paragraph * 4, "a" * 30_000, "é" * 20_000, "A\nb" * 9000, f"new start {paragraph}", paragraph[7:], "🙂" * 5000 + paragraph]


@pytest.mark.parametrize("size", [1, 3, 8192])
def test_equals_regular_expressions_whatever_is_remembered(size):
    cache = fim.ChunkCache(size)
    for doc, text in enumerate([*long_texts(), *long_texts()]):
        for doc_id in (doc, doc + 1000, doc + 5000):
            assert fim.transform(doc_id, text, cache, 1, fim.Rates()) == brute(doc_id, text)
    assert size == 1 or cache.hits > 0


@settings(max_examples=300, deadline=None)
@given(st.integers(), st.text(alphabet="aZ <P>SM\n9é日🙂", max_size=60))
def test_equals_regular_expressions(doc, text):
    assert fim.transform(doc, text, fim.ChunkCache(), 1, fim.Rates()) == brute(doc, text)


def test_a_hash_that_two_chunks_share_is_told_apart():
    cache = fim.ChunkCache()
    one, other = cache.summary(7, b"abc d"), cache.summary(7, b"1 2 3")
    assert (one.units, other.units) == (3, 5) and cache.misses == 2
    assert cache.summary(7, b"1 2 3") is other


def test_a_text_may_end_where_a_chunk_does():
    data = "".join(long_texts()).encode()
    ends, _ = fim.chunk_ends(data)
    for end in ends[:40]:
        again = fim.chunk_ends(data[:end])[0]
        assert again == ends[: ends.index(end) + 1]
        text = data[:end].decode(errors="ignore")
        assert fim.transform(3, text, fim.ChunkCache(), 1, fim.Rates()) == brute(3, text)


def test_every_cut_of_a_text():
    text = long_texts()[0][:3000]
    doc, units = fim.Document(text.encode(), fim.ChunkCache()), UNIT.findall(text)
    assert doc.n == len(units) and len(doc.at) > 3
    for k in range(len(units) + 1):
        before = "".join(units[:k])
        assert doc.cut(k) == (len(before.encode()), len(before))


def test_query_and_the_way_back(spark, odd, documents):
    rows = [(i, f"{'<' * (i % 3)}word {i} {'>' * (i % 2)} <P S> S> <S" * 3) for i in range(300)]
    rows += [(i + 400, f"text with a mark {mark} in it") for i, mark in enumerate(("<P>", "<S>", "<M>"))]
    for docs in (odd, documents(rows)):
        made = fim.fill_in_middle(docs).withColumn("again", fim.restored(F.col("output"), F.col("form")))
        found = sorted((tuple(r) for r in made.collect()), key=repr)
        given_rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert found == sorted(((doc, *brute(doc, text), text or "") for doc, text in given_rows), key=repr)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        digests = sorted(map(tuple, fim.digests(fim.fill_in_middle(docs)).collect()), key=repr)
        assert digests == sorted(((*row[:5], sha(row[5]), sha(row[6])) for row in found), key=repr)
    assert {row[2] for row in found} == {"plain", "psm", "spm"}


def test_seed_and_rates(spark, documents):
    rows = [(i, f"some words of text {i}") for i in range(200)]
    made = fim.fill_in_middle(documents(rows), seed=5, rates=fim.Rates(plain=50, suffix_first=100))
    assert {tuple(r) for r in made.collect()} == {(doc, *brute(doc, text, 5, 50, 100)) for doc, text in rows}


def test_empty_tables_and_clashing_names(spark, empty, clashing):
    assert fim.fill_in_middle(empty).collect() == []
    assert {tuple(r) for r in fim.fill_in_middle(clashing).collect()} == {(1, *brute(1, "right words here")), (2, 0, "plain", None, None, "")}
