"""Fill-in-the-middle training texts: documents cut in three and put in another order."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, once, ship, slices

#: A chunk ends where the top bits of a hash of the last WINDOW bytes are zero (on average every KB), never within LEAST
#: bytes of its start and always after MOST.
WINDOW, AVERAGE_BITS, LEAST, MOST = 16, 10, 256, 8192
#: Chunks remembered in each of two generations.
CACHED = 8192
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_GEAR = np.random.default_rng(13).integers(0, 1 << 32, 256, dtype=np.uint32)
_LETTER = np.array([chr(b).isalpha() and b < 0x80 for b in range(256)])
# Bytes that begin a code point.
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])


@dataclass(frozen=True)
class Rates:
    """Of 100 texts so many stay plain, and of 100 of the others so many have the suffix first."""

    plain: int = 10
    suffix_first: int = 20


def chunk_ends(data: bytes) -> tuple[list[int], list[int]]:
    """Where the content cuts a text into chunks, and the rolling hash at each cut."""
    hashes = _GEAR[np.frombuffer(data, np.uint8)]
    by = 1
    while by < WINDOW:
        # The sum of gear[byte at distance d] << d over the window, by doubling.
        hashes[by:] += hashes[:-by] << np.uint32(by)
        by *= 2
    places = np.flatnonzero(hashes >> np.uint32(32 - AVERAGE_BITS) == 0) + 1
    ends, last = [], 0
    for place in [*places.tolist(), len(data)]:
        while place - last > MOST:
            last += MOST
            ends.append(last)
        if place - last >= LEAST or last < place == len(data):
            last = place
            ends.append(last)
    return ends, hashes[np.array(ends) - 1].tolist()


class Summary:
    """What joins chunks: units and code points that begin in one, and whether a letter stands at either end.

    ``units`` counts as if no letter stood before the chunk; where one does and the chunk begins with a letter, the run
    goes on and there is one unit less.
    """

    __slots__ = ("chunk", "units", "chars", "first", "last")

    def __init__(self, chunk: bytes):
        starts = unit_starts(chunk, False)
        raw = np.frombuffer(chunk, np.uint8)
        self.chunk, self.units, self.chars = chunk, len(starts), int(_LEAD[raw].sum())
        self.first, self.last = bool(_LETTER[raw[0]]), bool(_LETTER[raw[-1]])


def unit_starts(chunk: bytes, after_letter: bool) -> np.ndarray:
    """The bytes at which a unit begins: a run of A-Z and a-z, or another code point."""
    raw = np.frombuffer(chunk, np.uint8)
    letter = _LETTER[raw]
    before = np.concatenate([[after_letter], letter[:-1]])
    return np.flatnonzero(np.where(letter, ~before, _LEAD[raw]))


class ChunkCache:
    """Summaries by chunk hash, each verified by the chunk's bytes; the ones used lately, in two generations."""

    def __init__(self, size: int = CACHED):
        self.size, self.new, self.old = size, {}, {}
        self.hits = self.misses = 0

    def summary(self, key: int, chunk: bytes) -> Summary:
        key = (key, len(chunk))
        found = self.new.get(key) or self.old.get(key)
        if found is None or found.chunk != chunk:
            self.misses += 1
            found = Summary(chunk)
        else:
            self.hits += 1
        if key not in self.new and len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = found
        return found


class Document:
    """A text as a sequence of summarised chunks."""

    def __init__(self, data: bytes, cache: ChunkCache):
        self.data, self.at, self.after = data, [0], [False]
        units, chars = [0], [0]
        start = 0
        if data:
            for end, key in zip(*chunk_ends(data), strict=True):
                own = cache.summary(key, data[start:end])
                units.append(units[-1] + own.units - (own.first and self.after[-1]))
                chars.append(chars[-1] + own.chars)
                self.at.append(end)
                self.after.append(own.last)
                start = end
        self.units, self.chars = units, chars

    @property
    def n(self) -> int:
        return self.units[-1]

    def cut(self, units: int) -> tuple[int, int]:
        """``(byte, code point)`` after so many units: sums over the chunks say in which chunk, only that one is looked at."""
        if units >= self.n:
            return len(self.data), self.chars[-1]
        chunk = int(np.searchsorted(self.units, units, "right")) - 1
        part = self.data[self.at[chunk] : self.at[chunk + 1]]
        byte = int(unit_starts(part, self.after[chunk])[units - self.units[chunk]])
        return self.at[chunk] + byte, self.chars[chunk] + int(_LEAD[np.frombuffer(part[:byte], np.uint8)].sum())


def transform(doc_id: int | None, text: str | None, cache: ChunkCache, seed: int, rates: Rates) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one document."""
    text = text or ""
    doc = Document(text.encode(), cache)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or h3 % 100 >= 100 - rates.plain:
        return doc.n, "plain", None, None, text
    low, high = sorted((h1 % (doc.n + 1), h2 % (doc.n + 1)))
    (a, a_chars), (b, b_chars) = doc.cut(low), doc.cut(high)
    prefix, middle, suffix = doc.data[:a].decode(), doc.data[a:b].decode(), doc.data[b:].decode()
    if h4 % 100 < rates.suffix_first:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return doc.n, form, a_chars, b_chars - a_chars, output


def fill_in_middle(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, rates: Rates = Rates()
) -> DataFrame:
    """``(<id_col>, n, form, prefix_chars, middle_chars, output)`` of each row, whole texts.

    A text is cut after whole units, ``[A-Za-z]+|[^A-Za-z]`` over its code points, of which it has n. Where to cut, and the
    form, follow a hash of ``seed`` and the id alone, so repeated rows get the same and ties do not arise. ``psm`` is
    ``<P>``prefix``<S>``suffix``<M>``middle, ``spm`` ``<S>``suffix``<P>``prefix``<M>``middle; texts that are empty or hold one
    of these marks stay ``plain``, with null counts. Null texts are empty ones; a null id is hashed as no digits; an empty
    table gives an empty one.

    Texts are cut into chunks where a rolling hash of their content says. Chunks that texts share are summarised once in
    a task, found by hash and verified by their bytes; sums over the summaries locate the cuts.
    """
    ship(df.sparkSession)

    def run(batches):
        cache = once("fim", ChunkCache)
        for batch in slices(batches):
            rows = [
                transform(doc, text, cache, seed, rates)
                for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            ]
            n, form, prefix, middle, output = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()), pa.array(output, pa.string()),
                ],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    made = id_and_text(df, id_col, text_col).mapInArrow(
        run, "id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )
    return made.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. No part holds a mark, so each part ends at the next mark of its order."""

    def part(mark_before: str, mark_after: str) -> Column:
        return F.substring_index(_after(output, mark_before), mark_after, 1)

    middle = _after(output, MIDDLE)
    psm = F.concat(part(PREFIX, SUFFIX), middle, part(SUFFIX, MIDDLE))
    spm = F.concat(part(PREFIX, MIDDLE), middle, part(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def _after(output: Column, mark: str) -> Column:
    return F.substring_index(output, mark, -1)


def digests(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and form of each output, and hashes of it and of the text restored from it."""
    return made.select(
        id_col, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def oracle_sql() -> str:
    return r"""
        WITH units AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                   sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
        ), hashes AS (
            SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                   ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM units
        ), cuts AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                        THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashes
        ), parts AS (
            SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
                   array_to_string(u[b + 1:], '') AS suffix FROM cuts
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """
