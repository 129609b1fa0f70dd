"""Quality rules: how much of a text repeats itself, from suffix arrays over its words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import BLANKS, by_place, id_and_text, slices

#: Base rules: fewer words than this fail; so does a text whose share of words in repeated windows is above the limit.
MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_PERCENT = 20
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Repeats shorter than this many words are ordinary language and count for nothing.
MIN_REPEAT = 8
#: A text is rejected when repeats cover more than this share of its words, or one repeat has more words than that. The
#: words of a repeat also lie in repeated windows, so the share only acts below the base rule's. 12 % is the limit that
#: the Gopher rules for web text set for repeated 8-grams (there of characters).
MAX_COVERED = 0.12
MAX_LONGEST = 50

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long"
)


def _ranks(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word, document of each word), all documents one after another."""
    ids: dict[bytes, int] = {}
    flat = np.fromiter((ids.setdefault(word, len(ids)) for own in words for word in own), np.int64)
    return flat, np.repeat(np.arange(len(words)), [len(own) for own in words])


def _dense(key: np.ndarray) -> np.ndarray:
    """Keys replaced by their ranks, 0 for the smallest."""
    order = np.argsort(key)
    sorted_key = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate(([False], sorted_key[1:] != sorted_key[:-1])))
    return rank


def _shifted(rank: np.ndarray, left: np.ndarray, by: int) -> np.ndarray:
    """The rank ``by`` places on, plus one; 0 past the end of the document."""
    out = np.zeros(len(rank), np.int64)
    out[:-by] = rank[by:] + 1
    out[left <= by] = 0
    return out


def _double(rank: np.ndarray, left: np.ndarray, by: int) -> np.ndarray:
    """Ranks of prefixes of ``2 * by`` words (cut at the end of the document) from those of ``by`` words."""
    if by >= len(rank):
        return rank
    return _dense(rank * (len(rank) + 1) + _shifted(rank, left, by))


def _windows_found_twice(rank4: np.ndarray, rank1: np.ndarray, doc: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Marks the starts of five-word windows that the same document has elsewhere too."""
    whole = np.flatnonzero(left >= WINDOW)
    if len(whole) < 2:
        return whole[:0]
    five = _dense(rank4[whole] * (len(rank1) + 1) + rank1[whole + WINDOW - 1])
    key = doc[whole] * (len(rank1) + 1) + five
    order = np.argsort(key)
    twin = key[order][1:] == key[order][:-1]
    return whole[order[np.concatenate(([False], twin)) | np.concatenate((twin, [False]))]]


def _union(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Marks the places that lie in one of the spans."""
    edges = np.bincount(starts, minlength=size + 1) - np.bincount(starts + lengths, minlength=size + 1)
    return np.cumsum(edges)[:size] > 0


def _longest_repeats(rank: np.ndarray, doc: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For every word, the length of the longest substring that starts at it and that its document has elsewhere too.

    Prefix doubling gives the suffix array of every document: ranks of prefixes of 1, 2, 4, ... words, until no two
    suffixes of a document agree. The kept ranks also give the longest common prefix of neighbours in the array: from
    the largest power of two down, where they agree on so many words, both move on by them. The larger of a suffix's
    two common prefixes is the depth of the innermost prefix interval around it, so the spans of these depths unite to
    the spans of all maximal repeats.
    """
    levels, by = [rank], 1
    while True:
        key = doc * (len(rank) + 1) + levels[-1]
        order = np.argsort(key)
        if not (key[order][1:] == key[order][:-1]).any():
            break
        levels.append(_double(levels[-1], left, by))
        by *= 2
    a, b = order[:-1], order[1:]
    same = doc[a] == doc[b]
    a, b = a[same], b[same]
    common = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        room = np.flatnonzero(np.minimum(left[a], left[b]) - common >= 1 << level)
        agree = levels[level][a[room] + common[room]] == levels[level][b[room] + common[room]]
        common[room[agree]] += 1 << level
    depth = np.zeros(len(rank), np.int64)
    np.maximum.at(depth, a, common)
    np.maximum.at(depth, b, common)
    return depth


def measure(texts: list[str | None]) -> dict[str, list[int]]:
    """The columns of ``COLUMNS`` for each text; a null text has no words."""
    texts = [text or "" for text in texts]
    words = [text.encode().split() for text in texts]  # bytes.split() knows no other white space than BLANKS
    n = np.array([len(own) for own in words], np.int64)
    out = {
        "n_words": n.tolist(),
        "word_chars": [len(text) - sum(map(text.count, BLANKS)) for text in texts],
        "n_symbols": [sum(map(text.count, SYMBOLS)) for text in texts],
        "n_dup_lines": [_duplicate_lines(text) for text in texts],
    }
    repeat_words, covered, longest = (np.zeros(len(texts), np.int64) for _ in range(3))
    if n.sum() >= 2:
        rank, doc = _ranks(words)
        ends = np.cumsum(n)
        left = ends[doc] - np.arange(len(doc))
        rank4 = _double(_double(rank, left, 1), left, 2)
        twice = _windows_found_twice(rank4, rank, doc, left)
        if len(twice):
            marked = _union(twice, np.full(len(twice), WINDOW), len(doc))
            repeat_words = np.bincount(doc[marked], minlength=len(texts))
            # A repeat of MIN_REPEAT words has repeated windows: the other documents need no suffix array.
            within = np.isin(doc, np.unique(doc[twice]))
            place = np.flatnonzero(within)
            own_doc, own_left = doc[place], left[place]
            depth = _longest_repeats(_dense(rank[place]), own_doc, own_left)
            starts = np.flatnonzero(depth >= MIN_REPEAT)
            marked = _union(starts, depth[starts], len(place))
            covered = np.bincount(own_doc[marked], minlength=len(texts))
            np.maximum.at(longest, own_doc[starts], depth[starts])
    return out | {"n_repeat_words": repeat_words.tolist(), "covered_words": covered.tolist(), "longest_repeat": longest.tolist()}


def _duplicate_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def repetition(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, ...COLUMNS, base_failed, kept)`` of each row, over its whole text.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``covered_words`` counts the words in the union of all maximal repeated
    substrings of at least ``MIN_REPEAT`` words, ``longest_repeat`` is the longest of those. ``kept`` is false for
    texts that fail the base rules, and for those whose repeats cover more than ``MAX_COVERED`` of the words or whose
    longest repeat has more than ``MAX_LONGEST`` words. Null and empty texts have 0 everywhere and are not kept;
    null ids stay null; repeated rows are measured each; an empty table gives an empty one. A task holds the suffix
    arrays of about 2 MB of text, or of one longer text, at a time.
    """

    names = [name.split()[0] for name in COLUMNS.split(", ")]

    def run(batches):
        for batch in slices(batches):
            found = measure(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(found[name], pa.int64()) for name in names), *map(pa.array, verdicts(found))],
                [id_col, *names, "base_failed", "kept"],
            )

    return id_and_text(df, id_col, text_col).mapInArrow(run, f"`{id_col}` long, {COLUMNS}, base_failed boolean, kept boolean")


def verdicts(found: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(whether the base rules fail, whether the text is kept) for measured texts."""
    n, covered, longest = (np.array(found[name], np.int64) for name in ("n_words", "covered_words", "longest_repeat"))
    base_failed = (n < MIN_WORDS) | (100 * np.array(found["n_repeat_words"], np.int64) > MAX_REPEATED_PERCENT * n)
    return base_failed, ~base_failed & (covered <= MAX_COVERED * n) & (longest <= MAX_LONGEST)


def clean_rows(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is kept: no shuffle, no join by id.

    A null text has no words and goes; rows that share an id or a text are judged each; names of columns may differ in
    case only; an empty table gives an empty one.
    """
    place, own = df.columns.index(text_col), by_place(df)

    def run(batches):
        for batch in slices(batches, place):
            yield batch.filter(pa.array(verdicts(measure(batch.column(place).to_pylist()))[1]))

    return own.mapInArrow(run, own.schema).toDF(*df.columns)
