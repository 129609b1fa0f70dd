"""The trie of conversation beginnings against brute force over whole turns."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from basketrank.llm import prefixtrie

COLUMNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), key, (role, text)))
    own = {c: [turn for _, _, turn in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        words = len(path[-1][1].encode().split()) if path else 0
        saved[path] = sum(saved[k] for k in children[path]) + (len(members[path]) - 1) * words
    out = set()
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(path))))
        out.add((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children[path]), leaves[path], saved[path],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def found(df, **options):
    rows = [tuple(r) for r in prefixtrie.prefix_trie(df, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def rows():
    """Shared beginnings, equal conversations, short and absent bases, ties, nulls and repeated rows."""
    rng = random.Random(3)
    out = []
    for conv in [*range(-25, 130), 10**15, 10**15 + 7]:
        if conv == 40:
            continue  # the base of others is absent
        size = 1 if conv in (60, 61, 63) else rng.randrange(1, 12)
        for turn in range(size):
            text = rng.choice(["one", "one two", "a\tb\x0bc d", "", None]) if turn > 2 else f"start {conv // 50}"
            out.append((conv, turn, rng.choice(["user", None]) if turn > 4 else "user", text))
    for conv in range(200, 260):  # a large group of equal ones
        out += [(conv, turn, "user", f"same words {turn}") for turn in range(7)]
    out += [(300, 0, "user", "tie"), (300, 0, "user", "tie b"), (300, None, "user", "null turn"), (300, None, None, None), (300, 0, "user", "tie")]
    out += [(None, 0, "user", "of no conversation"), (301, 2, "ab", "c"), (302, 2, "a", "bc")]
    return out


@pytest.mark.parametrize("options", [{}, {"segment": 1, "pending": 1}, {"segment": 2, "pending": 3}, {"segment": 7}])
def test_equals_brute_force_however_paths_are_cut(spark, rows, options):
    assert found(spark.createDataFrame(rows, COLUMNS).repartition(5), **options) == brute(rows)


@pytest.mark.parametrize("shards", ["1", "2", "31"])
def test_the_number_of_shards_changes_nothing(spark, rows, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        assert found(spark.createDataFrame(rows, COLUMNS), segment=4, pending=2) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_conversation_with_most_of_all_rows(spark):
    rng = random.Random(5)
    rows = [(conv, turn, "user", rng.choice(["yes", "no no"])) for conv, size in ((0, 3000), (20, 3000), (3, 2), (5, 700)) for turn in range(size)]
    assert found(spark.createDataFrame(rows, COLUMNS).repartition(7), segment=500) == brute(rows)


def test_an_empty_table_has_no_node(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert found(empty) == set()
    assert found(spark.createDataFrame([(None, 1, "user", "x")], COLUMNS)) == set()


def test_clashing_columns_do_no_harm(spark):
    rows = [(1, 0, "user", "hello there"), (2, 0, "user", "hello there")]
    names = "conv_id long, turn long, role string, text string, Text string, conv string, key string, place int, N long, root string"
    wide = spark.createDataFrame([(*row, "x", "y", "z", 4, 5, "r") for row in rows], names)
    assert found(wide) == brute(rows)
