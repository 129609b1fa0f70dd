"""Near duplicates by an inverted join of MinHash signature coordinates."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrank.sources.storage import broadcast_if_small

from .common import Memo, id_and_text, once, slices, staged
from .components import components

#: Coordinates of a signature, and the chance that a link at the threshold has too few of them in common.
COORDINATES, MISS = 64, 1e-6
#: Posting lists are dealt out in blocks of about so many documents and bytes of shingles, and compared in tiles of so many rows.
BLOCK_ROWS, BLOCK_BYTES, TILE_ROWS = 2048, 16 << 20, 256
MEMO_WORDS = 100_000

# Odd multipliers: coordinate c of a set is the smallest upper half of (multiplier c * shingle).
_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The most coordinates that two sets of this similarity share with a chance of at least ``1 - miss``."""
    p, below = percent / 100, 0.0
    for matches in range(coordinates + 1):
        below += math.comb(coordinates, matches) * p**matches * (1 - p) ** (coordinates - matches)
        if below > miss:
            return max(1, matches)
    return coordinates


class Shingler:
    """Sets of hashed word shingles, as sorted 64-bit integers."""

    def __init__(self, size: int):
        self.size = size
        self.words = Memo(xxhash.xxh64_intdigest, MEMO_WORDS)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The distinct shingles of each text: runs of ``size`` words, or all words if they are fewer."""
        out = []
        for text in texts:
            words = (text or "").encode().lower().split()  # lower-cases A-Z only, splits at [\x20\x09-\x0D]
            hashed = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
            size = min(self.size, len(words))
            if not size:
                out.append(hashed)
                continue
            with np.errstate(over="ignore"):
                mixed = np.zeros(len(words) - size + 1, np.uint64)
                for i in range(size):
                    mixed = (mixed ^ hashed[i : len(words) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(29)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(32)
            out.append(np.unique(mixed))
        return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The coordinates of a set that is not empty."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            np.minimum(low, (shingles[at : at + 2048, None] * _FACTORS).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def sketches(rows: DataFrame, size: int) -> DataFrame:
    """``(id, n_shingles, digest, keys)``; a key is a coordinate's number and value. Empty sets have neither."""

    def run(batches):
        shingler = once(("shingles", size), lambda: Shingler(size))
        numbers = np.arange(COORDINATES, dtype=np.int64) << 32
        for batch in slices(batches):
            sets = shingler.sets(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array([len(own) for own in sets], pa.int64()),
                    pa.array([hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None for own in sets], pa.binary()),
                    pa.array([numbers | signature(own) if len(own) else None for own in sets], pa.list_(pa.int64())),
                ],
                ["id", "n_shingles", "digest", "keys"],
            )

    return rows.mapInArrow(run, "id long, n_shingles long, digest binary, keys array<long>")


def postings(sets: DataFrame, matches: int) -> DataFrame:
    """``(node, key, n_shingles, earlier)``: the keys under which each set of ``sets (node, keys, n_shingles)`` is posted.

    Sets that share ``matches`` coordinates share one among the rarest ``COORDINATES - matches + 1`` of either, in one
    order for all: by how many sets have the key. Keys that a single set has come first there and need no posting, so
    a set is posted under the rest of its prefix, and not at all (the merge skips it) if too few of its keys occur
    elsewhere. Keys that very many sets have, as of a passage that many documents quote, come last. ``earlier`` has a
    bit for the coordinate of each key before this one (none for an id that several sets have).
    """
    keys = sets.select("node", "n_shingles", F.explode("keys").alias("key"))
    shared = staged(keys.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1"), "shared")
    coordinates = F.transform("found", lambda post: F.shiftright(post["key"], 32).cast("int"))
    before = F.expr("aggregate(slice(coordinates, 1, place), 0L, (bits, c) -> bits | shiftleft(1L, c))")
    return (
        keys.join(shared, "key").groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("sets", "key"))).alias("found"), F.max("n_shingles").alias("n_shingles"))
        .where(F.size("found") >= matches).withColumn("coordinates", coordinates)
        .withColumn("alone", F.size(F.array_distinct("coordinates")) == F.size("coordinates"))
        .select("node", "n_shingles", "coordinates", "alone", F.posexplode(F.slice("found", F.lit(1), F.size("found") - (matches - 1))).alias("place", "post"))
        .select("node", F.col("post.key").alias("key"), F.col("post.sets").alias("sets"), "n_shingles", F.when(F.col("alone"), before).otherwise(F.lit(0).cast("long")).alias("earlier"))
    )


def posting_lists(posts: DataFrame) -> DataFrame:
    """The postings of all lists with several members; of lists with the same members the one that comes first."""
    lists = posts.groupBy("key").agg(
        F.min("sets").alias("sets"), F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("sum"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("xor"),
    ).where("n > 1")
    first = lists.groupBy("n", "sum", "xor").agg(F.min(F.struct("sets", "key")).alias("first")).select(F.col("first.key").alias("key"))
    return posts.drop("sets").join(staged(first, "first"), "key")


def _similar(a: list[np.ndarray], b: list[np.ndarray], wanted: np.ndarray, percent: int) -> np.ndarray:
    """Which of the wanted pairs have 100 * intersection >= percent * union, on the full sets."""
    na, nb = np.array([len(own) for own in a]), np.array([len(own) for own in b])
    total = na[:, None] + nb[None, :]
    # A link needs an intersection of percent / (100 + percent) of the two sizes.
    wanted = wanted & (np.minimum(na[:, None], nb[None, :]) * (100 + percent) >= percent * total)
    rows, columns = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    if not len(rows):
        return wanted
    pairs = np.argwhere(wanted)
    common = np.zeros(wanted.shape, np.int64)
    every = np.unique(np.concatenate([a[i] for i in rows]))
    if len(rows) * len(columns) * len(every) < len(pairs) * 30_000:
        # Many pairs: one column for each shingle, products of 0/1 matrices.
        step = max(1, (4 << 20) // (len(rows) + len(columns)))
        for at in range(0, len(every), step):
            part = every[at : at + step]
            left, right = (_incidence([own[i] for i in chosen], part) for own, chosen in ((a, rows), (b, columns)))
            common[np.ix_(rows, columns)] += (left @ right.T).astype(np.int64)
    else:
        for i, j in pairs.tolist():
            common[i, j] = len(np.intersect1d(a[i], b[j], assume_unique=True))
    return wanted & (100 * common >= percent * (total - common))


def _incidence(sets: list[np.ndarray], every: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(every)), np.float32)
    for row, own in zip(out, sets, strict=True):
        place = np.minimum(np.searchsorted(every, own), len(every) - 1)
        row[place[every[place] == own]] = 1
    return out


def _block_links(rows: list[tuple], matches: int, percent: int) -> list[tuple[int, int]]:
    """Links that join components in a block, or in two, from its ``(node, block, root, earlier, set, signature)``.

    Collisions are counted for all pairs of a tile at once. The merge skips pairs of one component and pairs that an earlier
    list has: they agree in a coordinate that both have before this list's. Those with enough collisions are confirmed
    on the full sets. Links within parts that are joined already are left out: they change no component.
    """
    blocks = sorted({row[1] for row in rows})
    sides = [[row for row in rows if row[1] == block] for block in blocks[:2]]
    tiles = [[side[at : at + TILE_ROWS] for at in range(0, len(side), TILE_ROWS)] for side in sides]
    first, second = tiles[0], tiles[-1]
    parent: dict[int, int] = {}

    def find(node: int) -> int:
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = parent[above]
            node = above
        return node

    out = []
    for number, left in enumerate(first):
        for right in second if len(blocks) > 1 else first[number:]:
            roots, others = ([find(row[2]) for row in side] for side in (left, right))
            for i, j in np.argwhere(_tile_links(left, right, roots, others, matches, percent)).tolist():
                x, y = find(roots[i]), find(others[j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((left[i][0], right[j][0]))
    return out


def _tile_links(first: list[tuple], second: list[tuple], roots: list[int], others: list[int], matches: int, percent: int) -> np.ndarray:
    """Which rows of two tiles, or of one with itself, are linked: those of components that are not joined yet."""
    wanted = np.array(roots, np.int64)[:, None] != np.array(others, np.int64)[None, :]
    if first is second:
        wanted &= np.arange(len(first))[:, None] < np.arange(len(second))[None, :]
    if not wanted.any():
        return wanted
    a, b = (np.stack([row[5] for row in side]) for side in (first, second))
    agree = np.zeros((len(a), len(b)), np.uint8)
    for c in range(COORDINATES):
        agree += a[:, c][:, None] == b[:, c][None, :]
    wanted &= agree >= matches
    before, behind = (np.array([row[3] for row in side], np.int64).view(np.uint64) for side in (first, second))
    bits = np.uint64(1) << np.arange(COORDINATES, dtype=np.uint64)
    pairs = np.argwhere(wanted)
    for at in range(0, len(pairs), 65_536):
        i, j = pairs[at : at + 65_536].T
        met = (a[i] == b[j]) & ((before[i] & behind[j])[:, None] & bits != 0)
        wanted[i, j] = ~met.any(axis=1)
    return _similar([row[4] for row in first], [row[4] for row in second], wanted, percent)


def member_sets(rows: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``(node, shingles, signature)`` of the rows whose ids are ``nodes``, as bytes."""

    def shingled(batches):
        shingler = once(("shingles", size), lambda: Shingler(size))
        for batch in slices(batches):
            sets = shingler.sets(batch.column("text").to_pylist())
            keep = [i for i, own in enumerate(sets) if len(own)]
            if keep:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(keep)),
                        pa.array([sets[i].tobytes() for i in keep], pa.binary()), pa.array([signature(sets[i]).tobytes() for i in keep], pa.binary()),
                    ],
                    ["node", "shingles", "signature"],
                )

    # A measured broadcast spares a shuffle of all texts, most of which no other document is like.
    chosen = broadcast_if_small(staged(nodes.withColumnRenamed("node", "id"), "chosen"))
    return rows.join(chosen, "id", "left_semi").mapInArrow(shingled, "node long, shingles binary, signature binary")


def unit_links(placed: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """``(a, b)``: links in units ``(list, low, high)``, each the members of one block or two, of bounded size."""
    # By range, as ranges are even: by hash, several units of a long list would meet in one task.
    dealt = (
        placed.join(sets, "node").select("list", "low", "high", "block", "node", "root", "earlier", "shingles", "signature")
        .repartitionByRange("list", "low", "high").sortWithinPartitions("list", "low", "high", "block", "node")
    )

    def compare(batches):
        key, unit = None, []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[:3] != key:
                    yield from _links_batch(key, unit, matches, percent)
                    key, unit = row[:3], []
                unit.append((row[4], row[3], row[5], row[6], np.frombuffer(row[7], np.uint64), np.frombuffer(row[8], np.uint32)))
        yield from _links_batch(key, unit, matches, percent)

    return dealt.mapInArrow(compare, "a long, b long")


def _links_batch(key, unit, matches, percent):
    # A unit of two blocks of which one is empty has nothing to compare.
    if len(unit) > 1 and (key[1] == key[2] or len({row[1] for row in unit}) == 2):
        links = _block_links(unit, matches, percent)
        if links:
            a, b = zip(*links, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _blocks_of(n, shingles):
    """How many blocks so many rows and shingles fill, as a number with a fraction."""
    return F.greatest(n / BLOCK_ROWS, shingles * 8 / BLOCK_BYTES)


def pivot_units(lists: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(node, pivot)`` and their units: each node with one pivot, of another component, of one of its lists.

    Every list has one pivot, another each ``turn``; a node takes the first by hash. So there is one pair a node.
    """
    pivots = staged(
        lists.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), F.col("node").alias("pivot"), F.col("root").alias("own"))).alias("to")), "pivots",
    )
    pairs = staged(
        lists.join(pivots, "key").where("root <> to.own").groupBy("node", "root", "n_shingles").agg(F.min("to").alias("to"))
        .select("node", "root", "n_shingles", F.col("to.pivot").alias("pivot"), F.col("to.own").alias("own")), "pairs",
    )
    parts = staged(
        pairs.groupBy("pivot", "own").agg(F.ceil(_blocks_of(F.count("*"), F.sum("n_shingles"))).alias("parts")), "parts"
    )
    part, none = F.pmod(F.xxhash64("node"), F.col("parts")).cast("string"), F.lit(0).cast("long")
    members = pairs.join(parts.select("pivot", "parts"), "pivot").select(F.col("pivot").alias("list"), part.alias("low"), F.lit("").alias("high"), F.lit("member").alias("block"), "node", "root", none.alias("earlier"))
    heads = parts.select("pivot", "own", F.explode(F.sequence(none, F.col("parts") - 1)).alias("part")).select(
        F.col("pivot").alias("list"), F.col("part").cast("string").alias("low"), F.lit("").alias("high"), F.lit("head").alias("block"), F.col("pivot").alias("node"), F.col("own").alias("root"), none.alias("earlier")
    )
    return pairs, members.unionByName(heads)


def block_units(lists: DataFrame) -> DataFrame:
    """Units that compare all members of a list but those of one component with each other.

    A component with a block's worth of members in a list has blocks of its own there; smaller ones share blocks.
    """
    parts = lists.groupBy("key", "root").agg(_blocks_of(F.count("*"), F.sum("n_shingles")).alias("fill"))
    parts = staged(parts.withColumn("large", F.col("fill") >= 1), "fills")
    bins = parts.where("NOT large").groupBy("key").agg(F.ceil(F.sum("fill")).alias("bins"))
    block = F.when(F.col("large"), F.concat_ws(":", "root", F.pmod(F.xxhash64("node"), F.ceil("fill")))).otherwise(
        F.concat_ws(":", F.lit("several"), F.pmod(F.xxhash64("root"), F.col("bins")))
    )
    cut = staged(
        lists.join(parts, ["key", "root"]).join(bins, "key", "left")
        .select("key", "node", "root", "earlier", block.alias("block"), F.when(F.col("large"), F.col("root")).alias("owner")), "cut",
    )
    blocks = staged(cut.select("key", "block", "owner").distinct(), "blocks")
    other = blocks.select("key", F.col("block").alias("high"), F.col("owner").alias("with"))
    apart = F.expr("(block < high AND NOT (owner <=> with AND owner IS NOT NULL)) OR (block = high AND owner IS NULL)")
    units = blocks.join(other, "key").where(apart).select("key", F.col("block").alias("low"), "high")
    ends = units.withColumn("block", F.explode(F.array_distinct(F.array("low", "high"))))
    return cut.join(staged(ends, "units"), ["key", "block"]).select(F.col("key").alias("list"), "low", "high", "block", "node", "root", "earlier")


def collision_links(lists: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """``(a, b)``: confirmed links that connect whatever the posting lists ``(node, key, n_shingles, earlier)`` link.

    First every node meets one pivot of its lists, as often as that joins a tenth of the nodes compared: many copies of one
    text are joined by about as many comparisons. Then all pairs that a list has of different components are
    compared, in blocks, each pair in the first list that has it. So no pair that could join two components is left out.
    """
    links, roots, turn = None, None, 0
    while True:
        rooted = lists.withColumn("root", F.col("node")) if roots is None else (
            lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        )
        rooted = staged(rooted, "rooted")
        mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
        mixed = staged(rooted.join(staged(mixed, "mixed"), "key"), "lists")
        pairs, units = pivot_units(mixed, turn)
        found = staged(unit_links(units, sets, percent, matches), "links")
        links = found if links is None else links.unionByName(found)
        compared, joined = pairs.count(), found.count()
        if joined * 10 < compared or not joined:
            break
        roots, turn = components(links), turn + 1
    return links.unionByName(staged(unit_links(block_units(mixed), sets, percent, matches), "links"))


def near_duplicates(
    df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(<id_col>, n_shingles, component_id, kept)`` of each row.

    A-Z is lower-cased; words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; a document is the set of its ``size``-word
    shingles, or all its words as one shingle if they are fewer. Documents are linked if 100 * intersection is at least
    ``percent`` * union; ``component_id`` is the smallest id a document reaches over links. Candidates are pairs whose
    collisions in the posting lists of signature coordinates reach ``least_matches`` (a link is missed with a chance of
    ``MISS``); links are confirmed on the full sets of 64-bit shingles.
    Rows without words are linked with nothing; rows that share an id are one node; a row without an id has no
    component id, is kept, and links nothing; an empty table gives an empty one.
    """
    rows = id_and_text(df, id_col, text_col)
    matches = least_matches(percent)
    own = staged(sketches(rows, size), "sketches")
    # Equal sets are one node: their links are those of the smallest id.
    nodes = staged(
        own.where("n_shingles > 0 AND id IS NOT NULL").groupBy("digest")
        .agg(F.min("id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")), "nodes",
    )
    lists = staged(posting_lists(staged(postings(nodes, matches), "posts")), "met")
    sets = staged(member_sets(rows.where("id IS NOT NULL"), lists.select("node").distinct(), size), "sets")
    links = collision_links(lists, sets, percent, matches)
    # An id of rows with different texts joins their sets.
    several = staged(
        own.where("n_shingles > 0 AND id IS NOT NULL").groupBy("id").agg(F.countDistinct("digest").alias("n")).where("n > 1").select("id"), "several",
    )
    same_id = own.join(several, "id", "left_semi").join(nodes.select("digest", "node"), "digest").select(F.col("id").alias("a"), F.col("node").alias("b"))
    joined = components(links.unionByName(same_id))
    named = nodes.select("digest", "node").join(joined, "node", "left")
    named = staged(named.select("digest", F.coalesce("root", "node").alias("component")), "components")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return own.select("id", "n_shingles", "digest").join(named, "digest", "left").select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def representatives(
    df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows, with all their columns, that ``near_duplicates`` keeps: the smallest id of each component."""
    found = near_duplicates(df, size, percent, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("id")).distinct()
    names = [f"_{i}" for i in range(len(df.columns))]
    doc = F.col(names[df.columns.index(id_col)])
    return df.toDF(*names).join(found, doc == F.col("id"), "left_anti").toDF(*df.columns)
