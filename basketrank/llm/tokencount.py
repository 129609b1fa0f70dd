"""Token counts by greedy longest match, without building the pieces."""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Memo, id_and_text, once, shared_bytes, slices

#: Words whose counts a worker remembers, twice.
MEMO_WORDS = 300_000


class LongestMatch:
    """A trie over the vocabulary with failure links.

    A node stands for the bytes that are read but not yet cut into pieces. When the next byte does not continue it,
    the failure link leads to the node of what is left after the pieces that greedy longest match would cut off, and
    ``popped`` tells how many those are. Every byte moves down once and every link pops at least one piece, so a word
    takes time in proportion to its length.
    """

    def __init__(self, pieces: Iterable[bytes]):
        self.next: dict[int, int] = {}
        ends = [False]
        edges: list[list[tuple[int, int]]] = [[]]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                if key not in self.next:
                    self.next[key] = len(ends)
                    edges[node].append((byte, len(ends)))
                    ends.append(False)
                    edges.append([])
                node = self.next[key]
            ends[node] = node > 0
        # -1: what has been read cannot be cut into pieces.
        self.fail, self.popped = [-1] * len(ends), [0] * len(ends)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for byte, child in edges[node]:
                queue.append(child)
                if ends[child]:
                    self.fail[child], self.popped[child] = 0, 1
                    continue
                back, popped = self.fail[node], self.popped[node]
                while back >= 0 and back << 8 | byte not in self.next:
                    popped += self.popped[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[child], self.popped[child] = self.next[back << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 (the unknown token) if it has no cut into pieces; 0 if it is empty."""
        step, fail, popped = self.next, self.fail, self.popped
        node = total = 0
        for byte in word:
            child = step.get(node << 8 | byte)
            while child is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                child = step.get(node << 8 | byte)
            node = child
        while node:
            total += popped[node]
            node = fail[node]
            if node < 0:
                return 1
        return total


def pieces_of(rank_file: bytes) -> list[bytes]:
    """The byte strings of a rank file: a piece in base64 and its rank on each line."""
    return [base64.b64decode(line.split()[0]) for line in rank_file.splitlines() if line.strip()]


def token_counts(
    df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(<id_col>, n_words, n_tokens)`` of each row, over its whole text.

    ``pattern`` cuts a text into words; each is cut greedily into the longest pieces of the rank file ``vocabulary``,
    and only their number is computed. Null and empty texts have 0 of both; a null id stays null; repeated rows are
    counted each; an empty table gives an empty one. Texts are read as a stream of words, so a long one takes no more
    memory than the memo of distinct words.
    """
    content = shared_bytes(df.sparkSession, vocabulary)

    def count(batches):
        automaton = once(("longest match", vocabulary), lambda: LongestMatch(pieces_of(content.value)))
        counts = once(("longest match", vocabulary, "counts"), lambda: Memo(lambda word: automaton.count(word.encode()), MEMO_WORDS))
        words_of = regex.compile(pattern)
        for batch in slices(batches):
            words, tokens = [], []
            for text in batch.column("text").to_pylist():
                if text is not None and len(text) > 1 << 20:
                    own = total = 0
                    for match in words_of.finditer(text):
                        own, total = own + 1, total + counts[match[0]]
                else:
                    found = words_of.findall(text or "")
                    own, total = len(found), sum(map(counts.__getitem__, found))
                words.append(own)
                tokens.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                [id_col, "n_words", "n_tokens"],
            )

    return id_and_text(df, id_col, text_col).mapInArrow(count, f"`{id_col}` long, n_words long, n_tokens long")
