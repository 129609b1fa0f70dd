"""Trie of shared conversation beginnings: sorted shards between splitters, and a skeleton of the splitters' paths."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, ship, staged

#: Turns of a conversation that one row holds, hex digits that stand for a turn, conversations rebuilt from one head.
SEGMENT, DIGITS, FAMILY = 256, 32, 20
#: Most shards, and conversations looked at for each: together they bound what the driver and a broadcast hold.
MAX_SHARDS, SAMPLED = 1000, 4
#: Rows a shard keeps back until their parent's smallest member is known; bytes of ids handed on at once.
PENDING, BLOCK_BYTES = 200_000, 1 << 16

_OUT = (
    "kind int, ref long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, text string, shard int, block int"
)
_TYPES = [pa.int32(), *[pa.int64()] * 8, pa.string(), pa.int32(), pa.int32()]
_NODE, _PARTIAL, _ENDS, _ROOT, _LATE = range(5)
_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns(df: DataFrame) -> DataFrame:
    """``(conv, place, key, words)``: a conversation's turns from 1 on, by number (null first), then by key.

    Rows are put in order by ranges and counted there, so a conversation of any length spans as many tasks as it needs.
    """
    own = pick(df, conv=("conv_id", "long"), turn=("turn", "long"), role=("role", "string"), text=("text", "string"))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGITS)
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("key")]
    ranged = (
        own.where("conv IS NOT NULL")
        .select("conv", "turn", key.alias("key"), F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"))
        .repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    )

    def count(batches):
        last, before = None, 0
        for batch in batches:
            conv = batch.column("conv").to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv)))) + 1
            if conv[0] == last:
                place[: starts[1] if len(starts) > 1 else len(conv)] += before
            last, before = conv[-1], place[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(place, pa.int64()), batch.column("key"), batch.column("words"), batch.column("part")],
                ["conv", "place", "key", "words", "part"],
            )

    placed = staged(ranged.mapInArrow(count, "conv long, place long, key string, words long, part int"), "placed")
    # Only the last conversation of a range can go on in the next one: as many rows as there are ranges at most.
    edges = placed.groupBy("part").agg(F.max("conv").alias("conv")).select("conv").distinct()
    sizes = placed.join(F.broadcast(edges), "conv").groupBy("conv", "part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv").orderBy("part")) - F.col("n")
    moved = sizes.withColumn("earlier", earlier).where("earlier > 0").select("conv", "part", "earlier")
    place = F.col("place") + F.coalesce("earlier", F.lit(0))
    return placed.join(F.broadcast(moved), ["conv", "part"], "left").select("conv", place.alias("place"), "key", "words")


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the head of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % 4


def segments(own: DataFrame, segment: int) -> DataFrame:
    """``(conv, n, seg, path, words)`` of the rebuilt conversations, ``segment`` turns a row.

    A conversation of n turns has rows 0 to n // segment; the last one is empty if n is a multiple.
    """
    heads = own.where("place <= 3").select(F.col("conv").alias("base"), "place", "key", "words")
    have = heads.groupBy("base").agg(F.max("place").alias("have"))
    each = own.groupBy("conv").agg(F.max("place").alias("own")).select("conv", "own", head_turns(F.col("conv")).alias("h"))
    each = each.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).join(have, "base", "left")
    each = each.withColumn("taken", F.least("h", F.coalesce("have", F.lit(0))))
    each = staged(each.withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "conversations")
    borrowed = each.join(heads, "base").where("place <= taken").select("conv", "n", F.col("place").alias("depth"), "key", "words")
    rest = own.join(each.select("conv", "n", "h", "taken"), "conv").where("place > h")
    rebuilt = borrowed.unionByName(rest.select("conv", "n", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "key", "words"))
    # Dealt out by segment, so that a very long conversation is in many tasks.
    seg = F.floor((F.col("depth") - 1) / segment).cast("int")
    grouped = rebuilt.withColumn("seg", seg).repartition("conv", "seg").groupBy("conv", "n", "seg").agg(
        F.sort_array(F.collect_list(F.struct("depth", "key", "words"))).alias("turns")
    )
    filled = grouped.select("conv", "n", "seg", F.array_join("turns.key", "").alias("path"), F.col("turns.words").alias("words"))
    none = each.where(F.col("n") % segment == 0).select(
        "conv", "n", F.floor(F.col("n") / segment).cast("int").alias("seg"), F.lit("").alias("path"), F.array().cast("array<bigint>").alias("words")
    )
    return filled.unionByName(none)


def rooted(segs: DataFrame, segment: int) -> DataFrame:
    """Adds ``root`` and ``next``: what stands for all turns before a row, and up to its end if another follows."""
    nothing = F.lit(None).cast("string")
    short = segs.where(F.col("n") < segment).withColumns({"root": F.lit(""), "next": nothing})
    by = Window.partitionBy("conv").orderBy("seg")
    marks = [F.xxhash64(F.lit(i), "seg", "path").cast("decimal(20,0)") for i in (1, 2)]
    name = lambda shift, frame: F.concat_ws(":", F.col("seg") + shift, *[F.sum(mark).over(frame).cast("string") for mark in marks])
    so_far, before = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(Window.unboundedPreceding, -1)
    long = segs.where(F.col("n") >= segment).withColumns({
        "root": F.when(F.col("seg") == 0, "").otherwise(name(0, before)),
        "next": F.when(F.col("path") != "", name(1, so_far)).otherwise(nothing),
    })
    # Only a full row has a next one.
    full = F.length("path") == DIGITS * segment
    return short.unionByName(long.withColumn("next", F.when(full, F.col("next"))))


class Skeleton:
    """The trie of the splitters' paths: numbers, parents, depths and words of its nodes."""

    def __init__(self, splitters: list[tuple]):
        self.roots: dict[str, list] = {}
        self.parent, self.depth, self.words, self.root = [], [], [], []
        for root, path, _, words in splitters:
            node = self._child(self.roots, root, -1, 0, 0, root)
            for depth in range(1, len(path) // DIGITS + 1):
                key = path[(depth - 1) * DIGITS : depth * DIGITS]
                node = self._child(node[1], key, node[0], depth, words[depth - 1], root)

    def _child(self, children, key, parent, depth, words, root):
        if key not in children:
            children[key] = [len(self.parent), {}]
            for column, value in ((self.parent, parent), (self.depth, depth), (self.words, words), (self.root, root)):
                column.append(value)
        return children[key]

    def finish(self, found: dict[int, tuple]) -> list[tuple]:
        """``(low, n, children, leaves, saved)`` of each node from the sums of the shards, children before parents."""
        size = len(self.parent)
        low, n, children, leaves, saved = [None] * size, [0] * size, [0] * size, [0] * size, [0] * size
        for node in range(size - 1, -1, -1):
            own = found.get(node, (None, 0, 0, 0, 0))
            low[node] = min((x for x in (low[node], own[0]) if x is not None), default=None)
            n[node] += own[1]
            children[node] += own[2]
            leaves[node] = leaves[node] + own[3] if children[node] else 1
            saved[node] += own[4] + (n[node] - 1) * self.words[node]
            up = self.parent[node]
            if up >= 0:
                low[up] = low[node] if low[up] is None else min(low[up], low[node])
                n[up] += n[node]
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
        return list(zip(low, n, children, leaves, saved, strict=True))


class _Node:
    __slots__ = ("sid", "trie", "words", "n", "low", "children", "leaves", "saved", "ends", "ended", "size", "block", "pending", "number")

    def __init__(self, trie, words):
        self.sid, self.trie, self.words = (trie[0] if trie else None), trie, words
        self.n = self.children = self.leaves = self.saved = self.size = self.block = 0
        self.low = self.number = None
        self.ends = [] if trie else hashlib.sha256()
        self.ended, self.pending = False, []

    def add(self, low, n, children, leaves, saved):
        self.low = low if self.low is None else min(self.low, low)
        self.n += n
        self.children += children
        self.leaves += leaves
        self.saved += saved


class Shard:
    """Finishes the nodes of a sorted run of paths; of skeleton nodes only what this run adds to them."""

    def __init__(self, number: int, roots: dict, first_depth: int, pending: int):
        self.number, self.roots, self.first_depth, self.limit = number, roots, first_depth, pending
        self.stack: list[_Node] = []
        self.root, self.path, self.out, self.waiting, self.late = None, "", [], 0, 0

    def add(self, root, path, words, conv, ends, below):
        """``below``: children, leaves and saved tokens that later rows found under the end of a full row, or None."""
        if root != self.root:
            self.close_to(0)
            self.root, self.path = root, ""
            self.stack = [_Node(self.roots.get(root), 0)]
        same = 0
        while path.startswith(self.path[same * DIGITS : (same + 1) * DIGITS] or "-", same * DIGITS) and same * DIGITS < len(path):
            same += 1
        self.close_to(same + 1)
        for depth in range(same, len(path) // DIGITS):
            above = self.stack[-1].trie
            self.stack.append(_Node(above[1].get(path[depth * DIGITS : (depth + 1) * DIGITS]) if above else None, words[depth]))
        self.path = path
        node = self.stack[-1]
        node.add(conv, 1, *(below or (0, 0, 0)))
        if ends:
            self.end(node, conv)

    def end(self, node, conv):
        text = f",{conv}" if node.ended else str(conv)
        if node.sid is None:
            node.ends.update(text.encode())
        else:
            # The commas between blocks are put in where they meet.
            node.ends.append(str(conv))
            node.size += len(text)
            if node.size >= BLOCK_BYTES:
                self.hand_on(node)
        node.ended = True

    def hand_on(self, node):
        self.out.append((_ENDS, node.sid, *[None] * 7, ",".join(node.ends), self.number, node.block))
        node.ends, node.size, node.block = [], 0, node.block + 1

    def close_to(self, depth):
        while len(self.stack) > depth:
            self.close(self.stack.pop())

    def close(self, node):
        depth = len(self.stack)
        if node.sid is not None:
            if node.ends:
                self.hand_on(node)
            self.out.append((_PARTIAL, node.sid, node.low, None, None, node.n, node.children, node.leaves, node.saved, None, None, None))
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.words
        for row in node.pending:
            self.out.append((*row[:4], node.low, *row[5:]))
        self.waiting -= len(node.pending)
        if node.number is not None:
            self.out.append((_LATE, node.number, node.low, *[None] * 9))
        if not depth and self.first_depth:
            self.out.append((_ROOT, None, node.low, None, None, node.n, node.children, leaves, saved, self.root, None, None))
            return
        row = (_NODE, None, node.low, self.first_depth + depth, None, node.n, node.children, leaves, saved, node.ends.hexdigest(), None, None)
        if not depth:
            self.out.append(row)
            return
        up = self.stack[-1]
        if up.sid is not None:
            up.add(node.low, node.n, 1, leaves, saved)
            self.out.append((_NODE, -1 - up.sid, *row[2:]))
            return
        up.add(node.low, node.n, 1, leaves, saved)
        up.pending.append(row)
        self.waiting += 1
        if self.waiting > self.limit:
            self.let_go()

    def let_go(self):
        """Rows that wait go out with the number of their parent, which follows when it is closed."""
        for node in self.stack:
            if node.pending:
                if node.number is None:
                    node.number = (self.number << 40) + self.late
                    self.late += 1
                self.out.extend((row[0], node.number, *row[2:]) for row in node.pending)
                node.pending = []
        self.waiting = 0


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in _OUT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names)


def _level(rows: DataFrame, first_depth: int, segment: int, pending: int) -> tuple[DataFrame, DataFrame]:
    """Nodes below the roots of one level's rows (and the root of the first), and ``(root, low, children, leaves, saved)``."""
    spark = rows.sparkSession
    shards = min(MAX_SHARDS, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    sample = sorted(map(tuple, rows.select("root", "path", "conv", "words").orderBy(F.xxhash64("conv"), "conv").limit(SAMPLED * shards).collect()))
    splitters = [sample[at] for at in sorted({len(sample) * i // shards for i in range(1, shards)})]
    skeleton = Skeleton(splitters)
    shared = spark.sparkContext.broadcast(([x[:3] for x in splitters], skeleton.roots))

    def deal(batches):
        keys = shared.value[0]
        for batch in batches:
            own = zip(*(batch.column(name).to_pylist() for name in ("root", "path", "conv")), strict=True)
            yield batch.append_column("shard", pa.array([bisect.bisect_right(keys, key) for key in own], pa.int32()))

    def finish(batches) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("shard", "root", "path", "words", "conv", "ends", "below"))
            for number, root, path, words, conv, ends, below in zip(*columns, strict=True):
                if shard is None or shard.number != number:
                    if shard is not None:
                        shard.close_to(0)
                        if shard.out:
                            yield _batch(shard.out)
                    shard = Shard(number, shared.value[1], first_depth, pending)
                shard.add(root, path, words, conv, ends, below)
                if len(shard.out) >= 10_000:
                    yield _batch(shard.out)
                    shard.out = []
        if shard is not None:
            shard.close_to(0)
            if shard.out:
                yield _batch(shard.out)

    given = "root string, path string, words array<long>, conv long, ends boolean, below array<long>"
    dealt = rows.select("root", "path", "words", "conv", "ends", "below").mapInArrow(deal, given + ", shard int")
    sorted_rows = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "root", "path", "conv")
    out = staged(sorted_rows.mapInArrow(finish, _OUT), "shards")

    sums = out.where(F.col("kind") == _PARTIAL).groupBy("ref").agg(
        F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens")
    )
    # At most MAX_SHARDS * (SEGMENT + 1) rows.
    done = skeleton.finish({row[0]: tuple(row)[1:] for row in sums.collect()})
    table = [
        (sid, low, first_depth + skeleton.depth[sid], done[skeleton.parent[sid]][0] if skeleton.parent[sid] >= 0 else None, n, children, leaves, saved, skeleton.root[sid], skeleton.depth[sid])
        for sid, (low, n, children, leaves, saved) in enumerate(done)
    ]
    names = "ref long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, root string, below int"
    own = spark.createDataFrame(table, names)

    def ends(batches):
        ref, sha = None, None
        for batch in batches:
            for now, text in zip(batch.column("ref").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if now != ref:
                    if sha is not None:
                        yield pa.RecordBatch.from_pydict({"ref": [ref], "ends_sha256": [sha.hexdigest()]}, pa.schema([("ref", pa.int64()), ("ends_sha256", pa.string())]))
                    ref, sha = now, hashlib.sha256(text.encode())
                else:
                    sha.update(f",{text}".encode())
        if sha is not None:
            yield pa.RecordBatch.from_pydict({"ref": [ref], "ends_sha256": [sha.hexdigest()]}, pa.schema([("ref", pa.int64()), ("ends_sha256", pa.string())]))

    # A hash is a chain, so a node's ids pass one task, as blocks of text that are never held together.
    blocks = out.where(F.col("kind") == _ENDS).select("ref", "shard", "block", "text").repartition("ref").sortWithinPartitions("ref", "shard", "block")
    hashed = blocks.mapInArrow(ends, "ref long, ends_sha256 string")
    skeletal = own.join(hashed, "ref", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    if first_depth:
        skeletal = skeletal.where("below > 0")
    local = out.where(F.col("kind") == _NODE).withColumnRenamed("text", "ends_sha256")
    late = out.where(F.col("kind") == _LATE).select("ref", F.col("conv_id").alias("parent"))
    parents = own.select((F.lit(-1) - F.col("ref")).alias("ref"), F.col("conv_id").alias("parent"))
    nodes = (
        local.where("ref IS NULL").select(*_RESULT)
        .unionByName(local.where("ref < 0").drop("parent_conv_id").join(F.broadcast(parents), "ref").withColumnRenamed("parent", "parent_conv_id").select(*_RESULT))
        .unionByName(local.where("ref >= 0").drop("parent_conv_id").join(late, "ref").withColumnRenamed("parent", "parent_conv_id").select(*_RESULT))
        .unionByName(skeletal.select(*_RESULT))
    )
    found = ["root", "low", "n_children", "n_leaves", "saved_tokens"]
    roots = out.where(F.col("kind") == _ROOT).withColumnRenamed("text", "root").withColumnRenamed("conv_id", "low").select(*found)
    return nodes, roots.unionByName(own.where("below = 0").withColumnRenamed("conv_id", "low").select(*found))


def prefix_trie(df: DataFrame, segment: int = SEGMENT, pending: int = PENDING) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` of each trie node.

    Turns are ordered by number, null first; those of one number by a hash of role and text, and repeated rows are turns
    of their own. A null role or text is empty. Conversation c is rebuilt: the first ``crc32(c) % 4`` turns of
    conversation ``c - c % 20``, then its own turns beyond as many. A node is a distinct sequence of first turns, named
    by its smallest member and its depth. Rows without a conv_id belong to no conversation; an empty table has no node.

    A path is a run of hashes, ``segment`` turns a row. Rows are dealt to shards between splitters from a bounded sample
    of conversations. Every node that two shards share is a prefix of a splitter, so the trie of these paths is broadcast;
    a shard, sorted, finishes all other nodes in one pass and adds up its part of the skeleton's. Paths beyond one row
    go on in a trie of their own below its end, deepest rows first, so nothing grows with a conversation's length.
    """
    ship(df.sparkSession)
    segs = staged(rooted(staged(segments(staged(turns(df), "turns"), segment), "segments"), segment), "rows")
    deepest = segs.agg(F.max("seg")).first()[0]
    if deepest is None:
        return df.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    length = F.length("path") / DIGITS
    segs = segs.withColumns({
        "ends": (F.col("seg") * segment + length == F.col("n")) & ((F.col("path") != "") | (F.col("n") == 0)),
        "below": F.lit(None).cast("array<long>"),
    })
    result, totals = None, None
    for level in range(deepest, -1, -1):
        rows = segs.where(F.col("seg") == level)
        if totals is not None:
            # The smallest member carries what lies below the end of a full row.
            sums = totals.select(F.col("root").alias("next"), F.col("low").alias("conv"), F.array("n_children", F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(0), "saved_tokens").alias("found"))
            full = rows.where("next IS NOT NULL").drop("below").join(sums, ["next", "conv"], "left").withColumnRenamed("found", "below")
            rows = staged(rows.where("next IS NULL").unionByName(full), "level")
        nodes, totals = _level(rows, level * segment, segment, pending)
        if level:
            totals = staged(totals, "totals")
        result = nodes if result is None else result.unionByName(nodes)
    return result


def oracle_sql() -> str:
    """The same rows by lists of whole turns."""
    return r"""
        WITH placed AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), lists AS (
            SELECT conv_id, list({role: role, text: text} ORDER BY place) AS turns,
                   xor(list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                       lambda crc, byte: list_reduce(
                           list_prepend(xor(crc, byte), list_transform(range(8), lambda i: i::BIGINT)),
                           lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
                   ), 4294967295) % 4 AS h
            FROM placed GROUP BY conv_id
        ), rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
            FROM lists c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 20
        ), members AS (
            SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
        ), nodes AS (
            SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
            FROM members GROUP BY ALL
        ), tree AS (
            SELECT n.*, p.conv_id AS parent_conv_id,
                   (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path) AS n_children,
                   CASE WHEN n.depth = 0 THEN 0
                        ELSE len(regexp_extract_all(n.path[n.depth].text, '[^\x20\x09-\x0D]+')) END * (n.n_convs - 1) AS saved
            FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
        )
        SELECT t.conv_id, t.depth, t.parent_conv_id, t.n_convs, t.n_children,
               count(*) FILTER (d.n_children = 0) AS n_leaves, sum(d.saved)::BIGINT AS saved_tokens, sha256(t.ends) AS ends_sha256
        FROM tree t JOIN tree d ON d.depth >= t.depth AND d.path[1:t.depth] = t.path
        GROUP BY t.conv_id, t.depth, t.parent_conv_id, t.n_convs, t.n_children, t.ends
    """
