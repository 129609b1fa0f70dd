"""Benchmark passages: the index, exact and proximity matches and their digest, against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from basketrank.llm import decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(documents, items, window=10):
    wanted = {}
    for item, text in items:
        own = words(text)
        for at in range(max(1, len(own) - window + 1) if own else 0):
            wanted.setdefault(tuple(own[at : at + window]), set()).add(item)
    out = []
    for doc, text in documents:
        own, hit, found = words(text), set(), set()
        for size in {len(w) for w in wanted}:
            for at in range(len(own) - size + 1):
                if (items_of := wanted.get(tuple(own[at : at + size]))) is not None:
                    hit |= set(range(at, at + size))
                    found |= items_of
        names = sorted(str(item) for item in found if item is not None)
        out.append((doc, len(own), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(8, 16)))) for i in range(40)]
    rows += [(100, "The whole, QUITE long; passage-of ten words and a bit more than that"), (101, "short one"), (102, "ñandú ÉTÉ 12"), (103, None), (104, " .,"), (105, "a a a a a a a a a a a")]
    rows += [(100, "of ten words and a bit more than that!"), (None, "no id here at all"), (9, "the whole quite long passage of ten words and"), (110, "short ONE")]
    return rows


@pytest.fixture(scope="module")
def texts(items):
    rng = random.Random(2)
    passage = items[40][1]
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(0, 300)))) for i in range(60)]
    rows += [(i, f"{rows[i][1]} {items[i % 40][1]}, {rows[i][1]}") for i in range(60)]
    rows += [(200, f"x {passage} y"), (201, passage.upper()), (202, passage[:-20]), (203, f"{passage} {passage}"), (204, " ".join(words(passage)[2:9])), (205, None), (206, "")]
    rows += [(207, "short"), (208, "one short one two"), (208, "no id here at all"), (None, "a short one"), (209, "ñandú été 12 ñandú ÉTÉ 12"), (210, "a " * 50_000), (211, "short\none"), (212, "ñandú Été 12")]
    return rows


def frame(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, text string")


def test_equals_brute_force(spark, texts, items):
    made = d.contamination(frame(spark, texts, "doc_id").repartition(5), frame(spark, items, "item_id"))
    assert made.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, made.collect()), key=repr) == brute(texts, items)


def test_equals_brute_force_with_other_windows(spark, texts, items):
    for window in (1, 3):
        made = d.contamination(frame(spark, texts, "doc_id"), frame(spark, items, "item_id"), window=window)
        assert sorted(map(tuple, made.collect()), key=repr) == brute(texts, items, window)


def test_the_index_posts_every_word_of_every_document(spark, texts):
    posted = d.index(frame(spark, texts, "doc_id").repartition(3))
    assert posted.where("term IS NOT NULL").agg(F.sum("n")).first()[0] == sum(len(words(text)) for _, text in texts)
    assert posted.where("row IS NOT NULL").count() == len(texts)
    assert all(len(row.places) == 4 * row.n for row in posted.where("term IS NOT NULL").collect())


def nearest(own, phrase, slop):
    """Narrowest runs in order around each place of a word that is unique in the phrase."""
    out = set()
    for at in range(len(own)):
        for end in range(at + len(phrase), min(len(own), at + len(phrase) + slop) + 1):
            run = own[at:end]
            rest = iter(run)
            if run[0] == phrase[0] and run[-1] == phrase[-1] and all(word in rest for word in phrase):
                out.add((at, end - 1))
    return {(a, b) for a, b in out if not any((x, y) != (a, b) and a <= x and y <= b for x, y in out)}


def test_proximity_matches(spark):
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice("abcdefxyz") for _ in range(60)) + " q " + " ".join(rng.choice("abcdef") for _ in range(5))) for i in range(40)]
    asked = d.phrases(frame(spark, [(1, "a b q"), (2, "q a"), (3, "b q c d")], "item_id"))
    posted = d.index(frame(spark, texts, "doc_id"))
    documents = {(r.block, r.row): words(dict(texts)[r.id]) for r in posted.where("row IS NOT NULL").collect()}
    names = {r.phrase: r.item for r in asked.collect()}
    for slop in (0, 2, 5):
        found = {(r.block, r.row, names[r.phrase], r.first, r.last) for r in d.search(posted, asked, slop).collect()}
        wanted = {
            (*key, item, a, b) for key, own in documents.items() for item, phrase in ((1, "a b q"), (2, "q a"), (3, "b q c d"))
            for a, b in nearest(own, phrase.split(), slop)
        }
        # A word of the phrase stands once in each text, so the narrowest run around it is the one.
        assert found == wanted and (slop == 0 or found)


def test_clean_rows_go_untouched(spark, texts, items):
    docs = frame(spark, texts, "doc_id").select("*", F.lit("x").alias("Text"), F.lit(1).alias("n_hit"), F.lit(2).alias("block"))
    kept = d.clean_rows(docs, frame(spark, items, "item_id"))
    assert kept.columns == docs.columns
    bad = {row[0] for row in brute(texts, items) if row[5]}
    assert sorted(r[0] for r in kept.collect()) == sorted(doc for doc, _ in texts if doc not in bad)


def test_empty_tables_and_clashing_names(spark, items, texts, odd, empty, clashing):
    none = frame(spark, [], "item_id")
    assert d.contamination(empty, frame(spark, items, "item_id")).collect() == []
    rows = d.contamination(frame(spark, texts, "doc_id"), none).collect()
    assert len(rows) == len(texts) and not any(r.contaminated or r.n_items for r in rows)
    rows = d.contamination(clashing, frame(spark, [(1, "right words")], "item_id")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in rows) == [(1, 3, 2), (2, 0, 0)]
    made = d.contamination(odd, frame(spark, items, "item_id")).collect()
    assert sorted(map(tuple, made), key=repr) == brute([(r.doc_id, r.text) for r in odd.collect()], items)
