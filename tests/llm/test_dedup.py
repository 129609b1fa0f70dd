"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketrank.llm import exactdedup, neardedup
from basketrank.llm.components import components


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def exact_brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(normal(text), []).append(doc)
    out = []
    for doc, text in rows:
        own = groups[normal(text)]
        keep = min((d for d in own if d is not None), default=None)
        out.append((doc, keep, len(own), doc == keep, hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [63, 3])
def test_exact_groups_also_where_hashes_collide(documents, odd, empty, bits):
    rng = random.Random(1)
    big = "".join(rng.choice("ab cd\n") for _ in range(60_000))
    rows = [(1, big), (2, big.replace("\n", "\t")), (3, big + "x"), (4, "x" + big), (5, "y" * 40_000), (6, "y" * 40_001)]
    rows += [(10 + i, rng.choice("uvw") * rng.randrange(1, 4)) for i in range(40)]
    for df in (documents(rows), odd, empty):
        expected = exact_brute([(r.doc_id, r.text) for r in df.collect()])
        assert sorted(map(tuple, exactdedup.exact_duplicates(df, hash_bits=bits).collect()), key=str) == expected


def test_chunks_depend_on_content_only():
    rng = random.Random(2)
    data = bytes(rng.choice(b"abcdefgh ") for _ in range(100_000))
    own = exactdedup.chunks(data)
    assert b"".join(own) == data and all(len(c) <= exactdedup.MOST for c in own) and len(own) > 20
    # A change at the front leaves most chunks alone.
    assert len({*exactdedup.chunks(b"new start " + data)} & {*own}) > 0.9 * len(own)
    assert exactdedup.chunks(b"") == [b""]


def test_one_row_of_each_text_stays(documents, odd, clashing):
    for df in (odd, documents([(1, "a b"), (2, "a  b"), (3, "c")]), clashing):
        texts = [normal(r["text"] if df is not clashing else r[2]) for r in df.collect()]
        kept = exactdedup.distinct_rows(df)
        assert kept.columns == df.columns
        left = [normal(r[df.columns.index("text")]) for r in kept.collect()]
        assert sorted(left) == sorted(set(texts))
    assert sorted(r.doc_id for r in exactdedup.distinct_rows(documents([(1, "a b"), (2, "a  b"), (3, "c")])).collect()) == [1, 3]


def near_brute(rows, size, percent):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    parent = {doc: doc for doc, _ in rows if doc is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][0], rows[j][0]
            if a is not None and b is not None and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted([(doc, len(own), None if doc is None else find(doc), doc is None or find(doc) == doc) for (doc, _), own in zip(rows, sets, strict=True)], key=str)


def near_rows():
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(40)) for _ in range(rng.choice([5, 30, 80]))) for _ in range(10)]
    rows = []
    for i in range(160):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = "x" + str(rng.randrange(99))
        rows.append((1000 - i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("size", "percent", "block"), [(3, 85, 512), (5, 80, 512), (3, 85, 15)])
def test_near_components(documents, monkeypatch, size, percent, block):
    monkeypatch.setattr(neardedup, "BLOCK_ROWS", block)
    rows = near_rows()
    found = neardedup.near_duplicates(documents(rows), size, percent).collect()
    assert sorted(map(tuple, found), key=str) == near_brute(rows, size, percent)


def test_near_components_of_odd_rows(odd, empty, clashing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, neardedup.near_duplicates(odd, 3, 85).collect()), key=str) == near_brute(rows, 3, 85)
    assert neardedup.near_duplicates(empty, 3, 85).collect() == []
    assert {(r.doc_id, r.n_shingles) for r in neardedup.near_duplicates(clashing, 3, 85).collect()} == {(1, 1), (2, 0)}


def test_representatives_keep_one_of_each_component(documents):
    rows = near_rows()
    kept = neardedup.representatives(documents(rows), 3, 85)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _, _, keep in near_brute(rows, 3, 85) if keep)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_similar_is_the_same_pairwise_and_by_matrices():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(40)]
    wanted = np.ones((40, 40), bool)
    got = neardedup._similar(sets, sets, wanted, 50)
    one = np.array([[neardedup._similar([a], [b], np.ones((1, 1), bool), 50)[0, 0] for b in sets] for a in sets])
    exact = np.array([[100 * len({*a} & {*b}) >= 50 * len({*a} | {*b}) for b in sets] for a in sets])
    assert (got == exact).all() and (one == exact).all()


def test_threshold_of_matches():
    assert neardedup.least_matches(85) > neardedup.least_matches(80) > 30
    assert neardedup.least_matches(100) == neardedup.COORDINATES


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 30)]
    star = [(100, i) for i in range(101, 130)]
    links = spark.createDataFrame([*chain, *star, (200, 200), (302, 301), (301, 302)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {i: 1 for i in range(2, 31)} | {i: 100 for i in range(101, 130)} | {302: 301}


def test_blocks_skip_pairs_of_one_component_and_of_earlier_lists():
    own = np.arange(100, dtype=np.uint64)
    sign = neardedup.signature(own)

    def links(*members):
        rows = [(node, "b", root, earlier, own, sign) for node, root, earlier in members]
        return neardedup._block_links(rows, neardedup.least_matches(85), 85)

    assert links((1, 1, 0), (2, 2, 0)) == [(1, 2)]
    assert links((1, 1, 0), (2, 1, 0)) == []
    # Both have the coordinate of bit 3 in a list before this one; the highest bit is one of the 64, too.
    assert links((1, 1, 8), (2, 2, 12)) == [] and links((1, 1, 8), (2, 2, 4)) == [(1, 2)]
    assert links((1, 1, -(1 << 63)), (2, 2, -(1 << 63))) == []
    # A component is joined once, whichever of its members is linked.
    assert len(links((1, 1, 0), (2, 1, 0), (3, 3, 0))) == 1


def test_tiles_of_a_block_give_the_links_of_one_tile(monkeypatch):
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 62, 120)).astype(np.uint64)
    rows = []
    for node in range(90):
        own = base.copy()
        own[rng.choice(len(base), rng.integers(0, 16), replace=False)] = rng.integers(0, 1 << 62, 1)
        own = np.unique(own)
        rows.append((node, "ab"[node % 2], node, 0, own, neardedup.signature(own)))
    matches = neardedup.least_matches(85)

    def joined(links):
        parent = list(range(90))
        for _ in range(90):
            for x, y in links:
                parent[x] = parent[y] = min(parent[x], parent[y])
        return parent

    for unit in (rows, [(node, "a", *rest) for node, _, *rest in rows]):
        monkeypatch.setattr(neardedup, "TILE_ROWS", 1000)
        whole = neardedup._block_links(unit, matches, 85)
        monkeypatch.setattr(neardedup, "TILE_ROWS", 7)
        cut = neardedup._block_links(unit, matches, 85)
        assert whole and joined(cut) == joined(whole) and len(cut) == len(whole)


def test_members_of_a_list_of_a_thousand_move_once(spark):
    lists = spark.range(1000).select(F.lit(5).cast("long").alias("key"), F.col("id").alias("node"), F.lit(100).cast("long").alias("n_shingles"), F.lit(0).cast("long").alias("earlier"), F.col("id").alias("root"))
    assert neardedup.block_units(lists).count() == 1000


def test_texts_are_not_shuffled_for_the_few_that_others_are_like(documents):
    rows = neardedup.id_and_text(documents([(1, "a b"), (2, "c d")]), "doc_id", "text")
    sets = neardedup.member_sets(rows, rows.select(F.col("id").alias("node")).distinct(), 3)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and sets.count() == 2
