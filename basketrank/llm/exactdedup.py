"""Exact duplicates by content-defined chunk recipes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, id_and_text, slices, staged

#: A chunk ends where the low bits of a hash of the last WINDOW bytes are zero (on average every 2 KB), never within
#: LEAST bytes of its start and always after MOST.
WINDOW, AVERAGE_BITS, LEAST, MOST = 32, 11, 512, 16384
#: Bits of a chunk's hash. Chunks with the same hash are told apart by their bytes, so fewer bits are as right.
HASH_BITS = 63

# A fixed random number for every byte value.
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def normalised(text: str) -> bytes:
    """UTF-8 of the text with every run of ``[\\x20\\x09-\\x0D]`` replaced by one space."""
    data = text.encode()
    if not data:
        return data
    ends = BLANKS.encode()
    words = data.split()  # at exactly these bytes
    if not words:
        return b" "
    return b" " * (data[0] in ends) + b" ".join(words) + b" " * (data[-1] in ends)


def chunks(data: bytes) -> list[bytes]:
    """Cut where the content says, so that the same bytes give the same chunks and a change moves few cuts."""
    if len(data) <= LEAST + WINDOW:
        return [data]
    # The sum of gear[byte at distance d] << d over the window, by doubling.
    rolled = _GEAR[np.frombuffer(data, np.uint8)]
    by = 1
    while by < WINDOW:
        rolled[by:] += rolled[:-by] << np.uint32(by)
        by *= 2
    # The high bits depend on all bytes of the window.
    places = np.flatnonzero(rolled[WINDOW:] >> np.uint32(32 - AVERAGE_BITS) == 0) + WINDOW + 1
    cuts, last = [0], 0
    for place in places.tolist():
        while place - last > MOST:
            last += MOST
            cuts.append(last)
        if place - last >= LEAST and place < len(data):
            last = place
            cuts.append(last)
    while len(data) - last > MOST:
        last += MOST
        cuts.append(last)
    return [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True)]


def _hash(chunk: bytes, bits: int) -> int:
    return int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "little") >> (64 - bits)


def recipes(df: DataFrame, hash_bits: int = HASH_BITS) -> DataFrame:
    """``(id, text_sha256, recipe array<long>)``: the hashes of each document's chunks, in order."""

    def run(batches):
        for batch in slices(batches):
            sha, recipe = [], []
            for text in batch.column("text").to_pylist():
                data = normalised(text or "")
                sha.append(hashlib.sha256(data).hexdigest())
                recipe.append([_hash(chunk, hash_bits) for chunk in chunks(data)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sha, pa.string()), pa.array(recipe, pa.list_(pa.int64()))],
                ["id", "text_sha256", "recipe"],
            )

    return df.mapInArrow(run, "id long, text_sha256 string, recipe array<long>")


def chunk_rows(df: DataFrame, hash_bits: int = HASH_BITS, places: bool = False) -> DataFrame:
    """``(hash, chunk)``, without what a batch has twice; with ``places`` ``(id, text_sha256, place, hash, chunk)``."""

    def run(batches):
        for batch in slices(batches):
            rows, seen = [], set()
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = normalised(text or "")
                sha = hashlib.sha256(data).hexdigest() if places else None
                for place, chunk in enumerate(chunks(data)):
                    if places or chunk not in seen:
                        seen.add(chunk)
                        rows.append((doc, sha, place, _hash(chunk, hash_bits), chunk))
            for at in range(0, len(rows), 1024):
                columns = list(zip(*rows[at : at + 1024], strict=True))
                names = ["id", "text_sha256", "place", "hash", "chunk"]
                types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
                keep = range(5) if places else (3, 4)
                yield pa.RecordBatch.from_arrays([pa.array(columns[i], types[i]) for i in keep], [names[i] for i in keep])

    schema = "hash long, chunk binary"
    return df.mapInArrow(run, f"id long, text_sha256 string, place int, {schema}" if places else schema)


def numbered(distinct: DataFrame) -> DataFrame:
    """``(hash, chunk, number)``: the distinct chunks of shared hashes, from 0 in the order of their bytes."""
    a, b = distinct.alias("a"), distinct.alias("b")
    # As many rows as chunks collide, which is next to none at 63 bits.
    return (
        a.join(b, (F.col("a.hash") == F.col("b.hash")) & (F.col("b.chunk") < F.col("a.chunk")), "left")
        .groupBy("a.hash", "a.chunk").agg(F.count("b.chunk").alias("number"))
    )


def identifiers(rows: DataFrame, hash_bits: int = HASH_BITS) -> DataFrame:
    """``(id, text_sha256, recipe, numbers)``: the verified identifiers of each document's chunks, in order.

    A hash that stands for one chunk only, as the distinct chunks show, is its identifier. Chunks of a shared hash
    are told apart by a number as well: ``numbers`` has (place, number) of those, and is empty otherwise.
    """
    distinct = chunk_rows(rows, hash_bits).distinct()
    shared = staged(distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "shared")
    own = recipes(rows, hash_bits)
    nothing = F.array().cast("array<struct<place:int,number:bigint>>")
    if shared.isEmpty():
        return staged(own.withColumn("numbers", nothing), "identifiers")
    numbers = staged(numbered(staged(distinct.join(shared, "hash", "left_semi"), "collided")), "numbers")
    places = (
        chunk_rows(rows, hash_bits, places=True).join(shared, "hash", "left_semi").join(numbers, ["hash", "chunk"])
        .select("text_sha256", "place", "number").distinct()
        .groupBy("text_sha256").agg(F.sort_array(F.collect_list(F.struct("place", "number"))).alias("numbers"))
    )
    joined = own.join(places, "text_sha256", "left").withColumn("numbers", F.coalesce("numbers", nothing))
    return staged(joined.select("id", "text_sha256", "recipe", "numbers"), "identifiers")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = HASH_BITS) -> DataFrame:
    """``(<id_col>, keep_id, group_size, kept, text_sha256)`` of each row.

    Texts are equal if they are after replacing each run of ``[\\x20\\x09-\\x0D]`` by one space. Each is cut into
    content-defined chunks. The distinct chunks, whose copies fold before their bytes move once, show which hashes
    stand for a single chunk and so identify it. Documents are equal if their ordered lists of identifiers are: whole
    texts are never moved or compared. Of equal texts the row with the smallest id stays. Null texts count as empty
    ones and equal those. A null id is kept only where the group has no other; rows that share id and text are kept or
    dropped together. An empty table gives an empty one.
    """
    own = identifiers(id_and_text(df, id_col, text_col), hash_bits)
    groups = own.groupBy("recipe", "numbers").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    # Written, so that the join deals both sides out itself and can split a large group of copies among tasks.
    groups = staged(groups.where("group_size > 1"), "groups")
    joined = own.join(groups, ["recipe", "numbers"], "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("id").alias(id_col), keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"), "text_sha256",
    )


def normal_sha256(text: Column) -> Column:
    """``text_sha256`` as a column expression."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " "), 256)


def distinct_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, with all its columns, of each group of equal texts: one of those with the smallest id."""
    found = staged(exact_duplicates(df, id_col, text_col).select(F.col(id_col).alias("id"), "kept", "text_sha256"), "verdicts")
    rows, ids = found.agg(F.count("*"), F.countDistinct("id")).first()
    names = [f"_{i}" for i in range(len(df.columns))]
    own = df.toDF(*names)
    doc, text = F.col(names[df.columns.index(id_col)]), F.col(names[df.columns.index(text_col)])
    if rows == ids:
        return own.join(found.where("NOT kept").select("id"), doc == F.col("id"), "left_anti").toDF(*df.columns)
    # Ids that are null or not unique need the text beside them.
    own = own.withColumn("_sha", normal_sha256(text))
    same = doc.eqNullSafe(F.col("id")) & (F.col("_sha") == F.col("text_sha256"))
    repeated = staged(found.groupBy("id", "text_sha256").agg(F.count("*").alias("n")).where("n > 1").select("id", "text_sha256"), "repeated")
    own = own.join(found.where("NOT kept").select("id", "text_sha256"), same, "left_anti")
    once = own.join(repeated, same, "left_semi").dropDuplicates([names[df.columns.index(id_col)], "_sha"])
    return own.join(repeated, same, "left_anti").unionByName(once).drop("_sha").toDF(*df.columns)
