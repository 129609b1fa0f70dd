"""Benchmark passages in documents, by a distributed positional inverted index."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrank.sources.storage import broadcast_if_small

from .common import Memo, id_and_text, once, ship, slices, staged

#: Words of a window; bytes of text in a block of the index (or one longer text).
WINDOW, BLOCK_BYTES = 10, 4 << 20
MEMO_WORDS = 400_000

# Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z is lower-cased: on UTF-8, runs of digits, letters and bytes from 0x80.
_WORD_BYTES = bytes(
    ord(chr(b).lower()) if chr(b) in string.ascii_letters else b if chr(b) in string.digits or b >= 0x80 else 0x20 for b in range(256)
)

_INDEX = "block long, term long, n int, places binary, starts binary, id long, row int"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


def _term(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def _terms(text: str | None) -> np.ndarray:
    words = words_of(text)
    memo = once("terms", lambda: Memo(_term, MEMO_WORDS))
    return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))


def index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index as a written table of blocks of documents, every word of every one of them posted.

    A block numbers the words of its documents through, with a place left free after each document. It has a row for each
    of its terms (64-bit hashes): ``n`` places, ascending, as 32-bit integers; one with the ``starts`` of its documents;
    and one per document (``row``, ``id``, ``n`` words). A frequent term has rows in many blocks, none longer than a block.
    """
    ship(df.sparkSession)
    rows = id_and_text(df, id_col, text_col).withColumn("part", F.spark_partition_id())

    def run(batches) -> Iterator[pa.RecordBatch]:
        count = 0
        for batch in slices(batches, limit=BLOCK_BYTES, rows=1 << 16):
            block = (batch.column("part")[0].as_py() << 32) + count
            count += 1
            own = [_terms(text) for text in batch.column("text").to_pylist()]
            yield from _block_rows(block, batch.column("id"), own)

    # Written once: places are found by block and row afterwards, whatever number of tasks reads them.
    return staged(rows.mapInArrow(run, _INDEX), "index", compression="zstd")


def _block_rows(block: int, ids: pa.Array, own: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(terms) for terms in own], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.uint32)
    terms = np.concatenate(own)
    places = np.arange(len(terms), dtype=np.uint32) + np.repeat(np.arange(len(own), dtype=np.uint32), sizes)
    order = np.argsort(terms, kind="stable")
    terms, places = terms[order], places[order]
    first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
    ends = np.append(first, len(terms))
    names = [field.split()[0] for field in _INDEX.split(", ")]
    total = len(own) + 1

    def batch(size, term=None, n=None, places=None, starts=None, id=None, row=None):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int32()]
        given = [pa.array(np.full(size, block)), term, n, places, starts, id, row]
        return pa.RecordBatch.from_arrays([pa.nulls(size, t) if c is None else c for c, t in zip(given, types, strict=True)], names)

    yield batch(total - 1, n=pa.array(sizes, pa.int32()), id=ids, row=pa.array(np.arange(len(own)), pa.int32()))
    yield batch(1, starts=pa.array([starts.tobytes()], pa.binary()))
    for at in range(0, len(first), 1 << 14):
        cut = ends[at : at + (1 << 14) + 1]
        data = places[cut[0] : cut[-1]].tobytes()
        offsets = ((cut - cut[0]) * 4).astype(np.int32)
        lists = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
        yield batch(len(cut) - 1, term=pa.array(terms[cut[:-1]]), n=pa.array(np.diff(cut), pa.int32()), places=lists)


def phrases(df: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(phrase, item, terms array<long>)``: each text's windows; all words of a text of fewer, none of one without."""
    rows = id_and_text(df, id_col, text_col)

    def run(batches):
        for batch in slices(batches, limit=256 << 10):
            items, lists = [], []
            for item, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = _terms(text)
                seen = set()
                for at in range(max(1, len(own) - window + 1) if len(own) else 0):
                    part = own[at : at + window]
                    if (key := part.tobytes()) not in seen:
                        seen.add(key)
                        items.append(item)
                        lists.append(part)
            for at in range(0, len(items), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items[at : at + 4096], pa.int64()), pa.array([list(x) for x in lists[at : at + 4096]], pa.list_(pa.int64()))], ["item", "terms"]
                )

    found = rows.mapInArrow(run, "item long, terms array<long>")
    name = F.concat(*[F.hex(F.xxhash64(F.lit(i), "terms")) for i in (1, 2)])
    return staged(found.select(name.alias("phrase"), "item", "terms"), "phrases")


def rarest_first(posts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(phrase, terms, order, rarest)``: a phrase's offsets from its rarest term in the whole index to the commonest.

    Phrases with a term that the index has nowhere are left out.
    """
    counts = staged(posts.groupBy("term").agg(F.sum("n").alias("n")), "counts")
    each = wanted.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term")).join(counts, "term")
    ordered = each.groupBy("phrase", "size").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("found"))
    ordered = ordered.where(F.size("found") == F.col("size"))
    return wanted.join(
        ordered.select("phrase", F.col("found.offset").alias("order"), F.col("found")[0].getField("term").alias("rarest")), "phrase"
    )


def _exact(lists: dict[int, np.ndarray], terms: list[int], order: list[int]) -> np.ndarray:
    """Where the terms stand one after the other: lists shifted by their offsets, intersected from the shortest on."""
    starts = None
    for offset in order:
        own = lists.get(terms[offset])
        if own is None:
            return np.zeros(0, np.int64)
        own = own - offset
        if starts is None:
            starts = own
        else:
            at = np.minimum(np.searchsorted(own, starts), len(own) - 1)
            starts = starts[own[at] == starts]
        if not len(starts):
            break
    return starts


def _near(lists: dict[int, np.ndarray], terms: list[int], order: list[int], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the narrowest runs around each place of the rarest term that have all terms, in order."""
    if any(term not in lists for term in terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = last = lists[terms[order[0]]]
    alive = np.ones(len(first), bool)
    for offset in range(order[0] - 1, -1, -1):
        own = lists[terms[offset]]
        at = np.searchsorted(own, first) - 1
        alive &= at >= 0
        first = own[np.maximum(at, 0)]
    for offset in range(order[0] + 1, len(terms)):
        own = lists[terms[offset]]
        at = np.searchsorted(own, last, "right")
        alive &= at < len(own)
        last = own[np.minimum(at, len(own) - 1)]
    alive &= last - first + 1 <= len(terms) + slop
    return first[alive], last[alive]


def search(indexed: DataFrame, found_phrases: DataFrame, slop: int = 0) -> DataFrame:
    """``(block, row, phrase, first, last)``: each place where a phrase occurs, as word numbers from 0 in the document.

    With ``slop`` 0 the words stand one after the other; otherwise in order, with at most so many others among them:
    the narrowest such run around each place of the phrase's rarest word.
    """
    return _search(indexed, found_phrases, slop, False)


def cover(indexed: DataFrame, found_phrases: DataFrame) -> DataFrame:
    """``(block, row, n_hit, phrases array<string>)`` of documents with an exact match: words inside any, and which ones."""
    return _search(indexed, found_phrases, 0, True)


def _search(indexed: DataFrame, found_phrases: DataFrame, slop: int, covered: bool) -> DataFrame:
    asked = found_phrases.select("phrase", "terms").dropDuplicates(["phrase"])
    vocabulary = broadcast_if_small(staged(asked.select(F.explode("terms").alias("term")).distinct(), "vocabulary"))
    # Postings of other terms never leave the task that reads them, if the vocabulary is small enough to be there.
    posts = indexed.where("term IS NOT NULL").select("block", "term", "n", "places").join(vocabulary, "term", "left_semi")
    wanted = staged(rarest_first(posts, asked), "wanted")
    # The rarest term alone says which phrases can be in which block.
    candidates = staged(
        posts.select("block", F.col("term").alias("rarest")).join(wanted, "rarest").select("block", "phrase", "terms", "order"), "candidates"
    )
    needed = candidates.select("block", F.explode("terms").alias("term")).distinct()
    nothing = lambda kind: F.lit(None).cast(kind)
    blocks = candidates.select("block").distinct()
    # A block's lists, then the phrases to look for in it: one block, and one phrase at a time, is held.
    stream = (
        posts.join(needed, ["block", "term"]).select("block", F.lit(1).alias("kind"), "term", "places", nothing("string").alias("phrase"), nothing("array<long>").alias("terms"), nothing("array<int>").alias("order"))
        .unionByName(
            indexed.where("starts IS NOT NULL").join(blocks, "block")
            .select("block", F.lit(0).alias("kind"), "term", F.col("starts").alias("places"), nothing("string").alias("phrase"), nothing("array<long>").alias("terms"), nothing("array<int>").alias("order"))
        )
        .unionByName(candidates.select("block", F.lit(2).alias("kind"), nothing("long").alias("term"), nothing("binary").alias("places"), "phrase", "terms", "order"))
        .repartition("block").sortWithinPartitions("block", "kind")
    )

    def run(batches):
        block, lists, starts, marks, hits, out = None, {}, None, None, {}, []

        def done():
            if not covered or not hits:
                return []
            inside = np.cumsum(marks[:-1]) > 0
            sums = np.concatenate([[0], np.cumsum(inside)])
            return [(block, row, int(sums[starts[row + 1]] - sums[starts[row]]), sorted(hits[row])) for row in sorted(hits)]

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("block", "kind", "term", "places", "phrase", "terms", "order"))
            for now, kind, term, places, phrase, terms, order in zip(*columns, strict=True):
                if now != block:
                    out += done()
                    block, lists, hits = now, {}, {}
                if kind == 0:
                    starts = np.frombuffer(places, np.uint32).astype(np.int64)
                    marks = np.zeros(starts[-1] + 1, np.int32)
                elif kind == 1:
                    lists[term] = np.frombuffer(places, np.uint32).astype(np.int64)
                else:
                    if slop:
                        first, last = _near(lists, terms, order, slop)
                    else:
                        first = _exact(lists, terms, order)
                        last = first + len(terms) - 1
                    rows = np.searchsorted(starts, first, "right") - 1
                    # Never across the end of a document.
                    whole = last < starts[np.minimum(rows + 1, len(starts) - 1)] - 1
                    rows, first, last = rows[whole], first[whole], last[whole]
                    if covered:
                        np.add.at(marks, first, 1)
                        np.add.at(marks, last + 1, -1)
                        for row in np.unique(rows).tolist():
                            hits.setdefault(row, set()).add(phrase)
                    else:
                        shift = starts[rows]
                        out += [(block, row, phrase, a, b) for row, a, b in zip(rows.tolist(), (first - shift).tolist(), (last - shift).tolist(), strict=True)]
                if len(out) >= 4096:
                    yield from _rows(out, covered)
                    out = []
        yield from _rows(out + done(), covered)

    return stream.mapInArrow(run, "block long, row int, n_hit long, phrases array<string>" if covered else "block long, row int, phrase string, first long, last long")


def _rows(rows: list[tuple], covered: bool) -> Iterator[pa.RecordBatch]:
    names = ["block", "row", "n_hit", "phrases"] if covered else ["block", "row", "phrase", "first", "last"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string())] if covered else [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    for at in range(0, len(rows), 1024):
        columns = zip(*rows[at : at + 1024], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def contamination(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``(<id_col>, n_words, n_hit, n_items, items_sha256, contaminated)`` of each row.

    A-Z is lower-cased; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole texts. Every ``window`` consecutive
    words of an item are a window; an item of fewer words, but not none, is one window. Words of a document inside an
    occurrence of a window are hit. ``items_sha256`` hashes the ids of the items with occurring windows, sorted as
    strings and joined by commas. Null texts have no words; rows that share an id have a row each, items that share one
    count once; an item without an id marks words but is not listed; an empty table of documents gives an empty one, of
    items no hit. Words are compared as 64-bit hashes.
    """
    indexed = index(df, id_col, text_col)
    asked = phrases(benchmark, item_col, item_text_col, window)
    hits = staged(cover(indexed, asked), "hits")
    # Documents with the same phrases have the same items: those are looked up once.
    sets = hits.select("phrases").distinct()
    names = (
        sets.select("phrases", F.explode("phrases").alias("phrase")).join(asked.select("phrase", F.col("item").cast("string").alias("item")).distinct(), "phrase")
        .groupBy("phrases").agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select("phrases", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    )
    marked = hits.join(staged(names, "items"), "phrases").select("block", "row", "n_hit", "n_items", "items_sha256")
    documents = indexed.where("row IS NOT NULL").select("block", "row", "id", F.col("n").cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    return documents.join(staged(marked, "marked"), ["block", "row"], "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )


def clean_rows(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text holds no benchmark window. Rows that share an id stay or go together."""
    bad = contamination(df, benchmark, id_col, text_col).where("contaminated").select(F.col(id_col).alias("id")).distinct()
    names = [f"_{i}" for i in range(len(df.columns))]
    doc = F.col(names[df.columns.index(id_col)])
    return df.toDF(*names).join(bad, doc.eqNullSafe(F.col("id")), "left_anti").toDF(*df.columns)


def oracle_sql() -> str:
    return r"""
        WITH words AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), cuts AS (
            SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM items WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[pos:pos + 9], ' ') AS phrase FROM cuts
        ), places AS (
            SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
        ), found AS (
            SELECT p.r, p.pos, p.size, x.item_id FROM places p
            JOIN windows x ON x.size = p.size AND x.phrase = array_to_string(p.w[p.pos:p.pos + p.size - 1], ' ')
        ), hit AS (
            SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY r
        ), named AS (
            SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM words LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
    """
