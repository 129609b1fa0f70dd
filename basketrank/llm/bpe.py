"""Byte-level BPE as recursive queries of an in-process DuckDB, one in each task."""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
import tempfile

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Memo, id_and_text, once, pick, shared_bytes, slices

#: Encoded words that a worker remembers, twice.
MEMO_WORDS = 200_000
#: A recursive query takes words whose squared lengths add up to this: a bound on the rows that all its steps make.
ROWS_AT_ONCE = 4_000_000
#: A word of n bytes takes up to n steps over n rows. Longer words than this (bytes) are merged with a heap instead.
LONG_WORD = 400
#: What one DuckDB may hold; beyond it, its running query spills to the task's own temporary folder.
DUCKDB_MEMORY = "200MB"

# A row is a token at a position of a word. "cut" is the word's leftmost pair of minimum rank, as rank << 32 | position,
# or null once no two neighbours can be merged: those rows are the result. Every step merges that one pair: its left
# token becomes the merged one, its right token goes, and later positions move up by one.
ENCODE = """
WITH RECURSIVE parts AS (
  SELECT words.word, words.pos, words.token, best.cut
  FROM words LEFT JOIN (
    SELECT a.word, min((merges.merged::BIGINT << 32) | a.pos) AS cut
    FROM words a JOIN words b ON b.word = a.word AND b.pos = a.pos + 1
    JOIN merges ON merges.pair = (a.token::BIGINT << 32) | b.token
    GROUP BY a.word) best ON best.word = words.word
  UNION ALL
  SELECT * FROM (
    WITH merged AS MATERIALIZED (
      SELECT word,
             CASE WHEN pos > (cut & 4294967295) THEN pos - 1 ELSE pos END::INTEGER AS pos,
             CASE WHEN pos = (cut & 4294967295) THEN (cut >> 32)::INTEGER ELSE token END AS token
      FROM parts WHERE cut IS NOT NULL AND pos <> (cut & 4294967295) + 1),
    best AS (
      SELECT a.word, min((merges.merged::BIGINT << 32) | a.pos) AS cut
      FROM merged a JOIN merged b ON b.word = a.word AND b.pos = a.pos + 1
      JOIN merges ON merges.pair = (a.token::BIGINT << 32) | b.token
      GROUP BY a.word)
    SELECT merged.word, merged.pos, merged.token, best.cut FROM merged LEFT JOIN best ON best.word = merged.word)
)
SELECT word, pos, token FROM parts WHERE cut IS NULL
"""
# The text of a list of ids: the bytes of its tokens, aggregated in the order of their positions.
DECODE = """
SELECT word, unhex(string_agg(vocabulary.hex, '' ORDER BY pos)) AS bytes
FROM {tokens} JOIN vocabulary ON vocabulary.id = {tokens}.token GROUP BY word ORDER BY word
"""


def read_ranks(rank_file: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in rank_file.splitlines() if line.strip())
    return {base64.b64decode(piece): int(rank) for piece, rank in pairs}


class Codec:
    """Encodes and decodes words with one DuckDB connection."""

    def __init__(self, ranks: dict[bytes, int]):
        # Two neighbours merge if together they are a token, at the rank of that token.
        rows = [
            (left << 32 | right, rank)
            for piece, rank in ranks.items()
            for cut in range(1, len(piece))
            if (left := ranks.get(piece[:cut])) is not None and (right := ranks.get(piece[cut:])) is not None
        ]
        self.merges = dict(rows)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(":memory:")
        self.db.execute("SET threads = 1")
        self.db.execute(f"SET memory_limit = '{DUCKDB_MEMORY}'")
        self.db.execute(f"SET temp_directory = '{tempfile.gettempdir()}/duckdb-{os.getpid()}'")
        self._create("merges", pa.table({"pair": pa.array([r[0] for r in rows], pa.int64()), "merged": pa.array([r[1] for r in rows], pa.int32())}))
        self._create("vocabulary", pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": pa.array([p.hex() for p in ranks], pa.string())}))
        self.memo = Memo(self._unknown, MEMO_WORDS)

    def _create(self, name: str, rows: pa.Table) -> None:
        self.db.register("rows_in", rows)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM rows_in")
        self.db.unregister("rows_in")

    @staticmethod
    def _unknown(word: str) -> tuple[bytes, bytes]:
        raise KeyError(word)

    def learn(self, words: set[str]) -> None:
        """Put (ids as little-endian 32-bit integers, decoded bytes) of new words into the memo."""
        new = []
        self.memo.size = max(MEMO_WORDS, len(words))  # they are all needed at once
        for word in words:
            if self.memo.has(word):
                self.memo[word]  # stays in the younger generation
                continue
            if len(data := word.encode()) > LONG_WORD:
                ids = self._merge_long(data)
                self.memo.keep(word, (np.array(ids, "<i4").tobytes(), self.decode([ids])[0]))
            else:
                new.append((word, data))
        runs = np.cumsum([len(data) ** 2 for _, data in new]) // ROWS_AT_ONCE
        for run in np.split(np.arange(len(new)), np.flatnonzero(np.diff(runs)) + 1):
            if not len(run):
                continue
            part, encoded = zip(*new[run[0] : run[-1] + 1], strict=True)
            lengths = np.array([len(data) for data in encoded])
            firsts = np.cumsum(lengths) - lengths
            self._create("words", pa.table({
                "word": np.repeat(np.arange(len(part), dtype=np.int32), lengths),
                "pos": (np.arange(lengths.sum()) - np.repeat(firsts, lengths)).astype(np.int32),
                "token": self.byte[np.frombuffer(b"".join(encoded), np.uint8)],
            }))
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE encoded AS {ENCODE}")
            rows = self.db.execute("SELECT word, token FROM encoded ORDER BY word, pos").fetchnumpy()
            counts = np.bincount(rows["word"], minlength=len(part))
            ends = np.cumsum(counts) * 4
            ids = np.ascontiguousarray(rows["token"], "<i4").tobytes()
            decoded = self.db.execute(DECODE.format(tokens="encoded")).fetchall()
            begin = 0
            for word, end, (_, text) in zip(part, ends.tolist(), decoded, strict=True):
                self.memo.keep(word, (ids[begin:end], text))
                begin = end

    def _merge_long(self, data: bytes) -> list[int]:
        """The same contraction, leftmost minimum-rank pair first, with a heap of pairs in a linked list."""
        tokens = self.byte[np.frombuffer(data, np.uint8)].tolist()
        after = [*range(1, len(tokens)), -1]
        before = list(range(-1, len(tokens) - 1))

        def pair(at: int) -> tuple[int, int, int, int] | None:
            if at < 0 or after[at] < 0:
                return None
            merged = self.merges.get(tokens[at] << 32 | tokens[after[at]])
            return None if merged is None else (merged, at, tokens[at], tokens[after[at]])

        heap = [found for at in range(len(tokens)) if (found := pair(at))]
        heapq.heapify(heap)
        while heap:
            merged, at, left, right = heapq.heappop(heap)
            gone = after[at]
            if tokens[at] != left or gone < 0 or tokens[gone] != right:
                continue  # one of the two has been merged since
            tokens[at], tokens[gone] = merged, -1
            after[at] = after[gone]
            if after[at] >= 0:
                before[after[at]] = at
            for found in (pair(before[at]), pair(at)):
                if found:
                    heapq.heappush(heap, found)
        return [token for token in tokens if token >= 0]

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        """The bytes of lists of ids; an id outside the vocabulary is an error."""
        lengths = np.array([len(own) for own in ids], np.int64)
        flat = np.concatenate([np.asarray(own, np.int32) for own in ids]) if ids else np.empty(0, np.int32)
        firsts = np.cumsum(lengths) - lengths
        self._create("tokens", pa.table({
            "word": np.repeat(np.arange(len(ids), dtype=np.int32), lengths),
            "pos": (np.arange(len(flat)) - np.repeat(firsts, lengths)).astype(np.int32), "token": flat,
        }))
        unknown = self.db.execute("SELECT any_value(token) FROM tokens ANTI JOIN vocabulary ON id = token").fetchone()[0]
        if unknown is not None:
            raise ValueError(f"id {unknown} is not in the vocabulary")
        found = dict(self.db.execute(DECODE.format(tokens="tokens")).fetchall())
        return [found.get(i, b"") for i in range(len(ids))]


def _codec(vocabulary: str, content) -> Codec:
    return once(("bpe", vocabulary), lambda: Codec(read_ranks(content.value)))


def _encoded(batches, codec: Codec, pattern: str):
    """(batch, for each row the list of (ids, decoded bytes) of its words)."""
    words_of = regex.compile(pattern)
    for batch in slices(batches):
        found = [words_of.findall(text or "") for text in batch.column("text").to_pylist()]
        codec.learn(set().union(*found))
        get = codec.memo.__getitem__
        yield batch, ([get(word) for word in words] for words in found)


def encode(
    df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(<id_col>, ids array<int>)``: byte-level BPE of the whole text by the ranks of a rank file.

    Every match of ``pattern`` is encoded by itself, without special tokens; characters that nothing matches are left
    out, as the pattern says. Null and empty texts give an empty list; a null id stays null; rows are encoded each,
    whatever repeats. A distinct word is encoded once for as long as the worker remembers it.
    """
    content = shared_bytes(df.sparkSession, vocabulary)

    def run(batches):
        for batch, rows in _encoded(batches, _codec(vocabulary, content), pattern):
            ids = [np.frombuffer(b"".join([own for own, _ in words]), "<i4") for words in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"]
            )

    return id_and_text(df, id_col, text_col).mapInArrow(run, f"`{id_col}` long, ids array<int>")


def decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(<id_col>, bytes)``: the bytes behind a list of ids. Null and empty lists give no bytes, null ids in a list
    are skipped; an id outside the vocabulary is an error. Bytes need not be whole UTF-8 characters."""
    content = shared_bytes(df.sparkSession, vocabulary)

    def run(batches):
        codec = _codec(vocabulary, content)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                ids = [[i for i in own or () if i is not None] for own in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(codec.decode(ids), pa.binary())], [id_col, "bytes"]
                )

    return pick(df, id=(id_col, "long"), ids=(ids_col, "array<int>")).mapInArrow(run, f"`{id_col}` long, bytes binary")


def round_trip_digests(
    df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(<id_col>, n_tokens, ids_sha256, decoded_sha256, same)`` of each row: encodes, decodes and hashes in one pass.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` over the bytes the
    ids decode to (both lowercase hex), ``same`` tells whether those are the text's own UTF-8 bytes. Ids and decoded
    bytes are those of ``encode`` and ``decode``; as a text is the sequence of its words, both are put together from
    what the queries gave for its distinct words, which spares sending every id through the JVM twice.
    """
    content = shared_bytes(df.sparkSession, vocabulary)

    def run(batches):
        for batch, rows in _encoded(batches, _codec(vocabulary, content), pattern):
            lengths, ids_hash, text_hash, same = [], [], [], []
            for text, words in zip(batch.column("text").to_pylist(), rows, strict=True):
                ids, decoded = b"".join([own for own, _ in words]), b"".join([own for _, own in words])
                lengths.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(decoded).hexdigest())
                same.append(decoded == (text or "").encode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lengths, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string()), pa.array(same, pa.bool_())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "same"],
            )

    return id_and_text(df, id_col, text_col).mapInArrow(
        run, f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean"
    )
