"""Packs tokenised documents into fixed windows by the sum-of-squares rule."""

from __future__ import annotations

import json
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import Memo, id_and_text, once, shared_bytes, slices

#: Words and pieces of words whose ids a worker remembers, twice.
MEMO_WORDS = 350_000
#: Windows held open by a task, at most 16 KB of ids each; beyond it they are consolidated.
MAX_OPEN = 4096


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _ids(tokens: list) -> bytes:
    return _bytes([token.id for token in tokens])


class WordTokenizer:
    """Ids of texts, word by word, for tokenizers whose tokens never reach over white space.

    That holds where the tokenizer first cuts by a pattern that leaves white space out. Words are remembered, and so
    are the pattern's pieces of words in the Latin blocks, for which normalising means lower case only; other words
    go through the tokenizer as they are. So do words that hold the string of an added token, which the library maps to
    the token's id wherever it stands. A piece has the ids that it has as a word, so both are remembered in one place.
    """

    def __init__(self, content: bytes, remembered: int = MEMO_WORDS):
        self.whole = Tokenizer.from_str(content.decode())
        settings = json.loads(content)
        added = [token["content"] for token in settings["added_tokens"]]
        self.added = regex.compile("|".join(map(regex.escape, added)) or "(?!)")
        # Words of ASCII letters hold no added token that has another character.
        self.lettered = any(own.isascii() and own.isalpha() for own in added)
        self.pieces_of = regex.compile(settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # Byte-level alphabet: printable Latin-1 characters stand for themselves, the others follow from U+0100 on.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [byte for byte in range(256) if byte not in shown]
        self.alphabet = {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(rest)}
        self.latin = regex.compile("[!-~\xa1-\xac\xae-ɏ]+")
        self.words = Memo(self._word, remembered)

    def _word(self, word: bytes) -> bytes:
        if word.isalpha() and not self.lettered:
            lower = word.lower()
            return _ids(self.whole.model.tokenize(word.decode())) if lower == word else self.words[lower]
        text = word.decode()
        if self.added.search(text) or not self.latin.fullmatch(text):
            return _bytes(self.whole.encode(text, add_special_tokens=False).ids)
        text = text.lower()
        pieces = [text] if text.isalpha() else self.pieces_of.findall(text)
        if len(pieces) == 1:
            return _ids(self.whole.model.tokenize(pieces[0].encode().decode("latin-1").translate(self.alphabet)))
        return b"".join([self.words[piece.encode()] for piece in pieces])

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.words.__getitem__, text.encode().split()))


class SumOfSquares:
    """Online packing of pieces into windows of ``size`` tokens.

    ``level[f]`` counts the open windows that hold f tokens. A piece of s tokens goes into the level f (0: a new
    window) for which the sum of all squared counts comes out smallest: that keeps windows of every fill at hand and
    closes them exactly full. What is still open at the end is laid end to end and cut, and the rest is cut into
    sequences of powers of two, which need no padding.
    """

    def __init__(self, size: int, first: int):
        if size < 2 or size & (size - 1):
            raise ValueError("the window must be a power of two")
        self.size, self.next = size, first
        self.level = np.zeros(size + 1, np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(size)]
        self.windows = 0
        self.out: list[tuple] = []

    def add(self, doc, ids: bytes) -> None:
        total, width = len(ids) // 4, self.size * 4
        whole = total // self.size * width
        for at in range(0, whole, width):
            self._close([(doc, at // 4, total, ids[at : at + width])])
        if whole < len(ids):
            self._place((doc, whole // 4, total, ids[whole:]))
            if self.windows > MAX_OPEN:
                self._lay_out(last=False)

    def _place(self, piece: tuple) -> None:
        size, level, own = self.size, self.level, len(piece[3]) // 4
        # Level f to f + own changes the sum of squares by 2 * (level[f + own] - level[f]) + 2; a full window counts
        # nowhere; a new one adds 2 * level[own] + 1.
        change = 2 * (level[own + 1 :] - level[1 : size + 1 - own]) + 2
        change[-1:] = 1 - 2 * level[size - own]
        change[level[1 : size + 1 - own] == 0] = np.iinfo(np.int64).max
        best = int(change.argmin()) if len(change) else 0
        if len(change) and change[best] <= 2 * level[own] + 1:
            fill = best + 1
            window = self.open[fill].pop()
            level[fill] -= 1
            self.windows -= 1
        else:
            fill, window = 0, []
        window.append(piece)
        if fill + own == size:
            self._close(window)
        else:
            self.open[fill + own].append(window)
            level[fill + own] += 1
            self.windows += 1

    def _close(self, window: list[tuple]) -> None:
        offset = 0
        for doc, start, total, ids in window:
            self.out.append((doc, start, total, ids, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def _lay_out(self, last: bool) -> None:
        pieces = [piece for windows in self.open for window in windows for piece in window]
        self.level[:], self.windows = 0, 0
        self.open = [[] for _ in range(self.size)]
        left = sum(len(piece[3]) // 4 for piece in pieces)
        goal, fill, window = self.size, 0, []
        for doc, start, total, ids in pieces:
            while ids:
                if fill == 0 and left < self.size:
                    goal = 1 << left.bit_length() - 1 if last else self.size
                cut = ids[: (goal - fill) * 4]
                window.append((doc, start, total, cut))
                own = len(cut) // 4
                ids, start, fill, left = ids[len(cut) :], start + own, fill + own, left - own
                if fill == goal:
                    self._close(window)
                    fill, window = 0, []
        if window:
            self.open[fill].append(window)
            self.level[fill] += 1
            self.windows = 1

    def finish(self) -> None:
        self._lay_out(last=True)


def pack(
    df: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    remembered: int = MEMO_WORDS,
) -> DataFrame:
    """``(<id_col>, start, length, ids, doc_tokens, sequence_id, offset)``: one row for each piece.

    A document is the ids of its whole text by the tokenizer file, with no special tokens put around it (their strings
    in the text get their ids, as by the library), and ``end_id``. It fills
    whole windows as long as it can; its rest is one piece and placed by the sum-of-squares rule among the open
    windows of its task. ``ids`` are little-endian unsigned 32-bit integers. ``sequence_id`` is unique over all tasks;
    pieces stand gapless from offset 0; every sequence is full or a power of two long. Null and empty texts are a
    document of ``end_id`` alone; null ids stay null; repeated rows are packed each; an empty table gives no piece.
    ``remembered`` bounds the words whose ids a worker keeps: fewer take less memory and more time.
    """
    content = shared_bytes(df.sparkSession, tokenizer)

    def run(batches):
        tokens = once(("word tokenizer", tokenizer, remembered), lambda: WordTokenizer(content.value, remembered))
        end = np.array([end_id], "<u4").tobytes()
        packer = SumOfSquares(size, TaskContext.get().partitionId() << 32)
        for batch in slices(batches):
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                packer.add(doc, tokens.ids(text or "") + end)
            yield from _rows(packer, id_col)
        packer.finish()
        yield from _rows(packer, id_col)

    return id_and_text(df, id_col, text_col).mapInArrow(
        run, f"`{id_col}` long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )


def _rows(packer: SumOfSquares, id_col: str):
    for at in range(0, len(packer.out), 512):
        doc, start, total, ids, sequence, offset = zip(*packer.out[at : at + 512], strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(own) // 4 for own in ids], pa.int64()),
                pa.array(ids, pa.binary()), pa.array(total, pa.int64()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()),
            ],
            [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )
    packer.out.clear()
