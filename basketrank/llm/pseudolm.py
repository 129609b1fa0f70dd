"""Masked pseudo-likelihood: a bidirectional window network predicts every word from both sides."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, ship, slices, staged

#: Outputs of the network: the most frequent words of the corpus, then buckets for all others by a hash (255 at most).
FREQUENT, BUCKETS = 96, 32
#: Words looked at on either side, width of the hidden layer.
REACH, HIDDEN = 2, 16
#: Passes over the corpus; in each, every task trains on all its documents, and the networks are averaged.
PASSES = 1
RATE, BATCH = 4.0, 1024
#: Scores up to this size need no care before ``exp`` in single precision.
LARGEST = 60
#: Words counted in a task before their counts go on.
COUNTED_WORDS = 200_000
#: Documents that share one list of their words while they are scored: up to so many different words, or words in all.
LISTED, TOGETHER = 500_000, 8_000_000
#: A hidden vector stands for each input beyond the outputs: the place before the first and after the last word.
EDGE = FREQUENT + BUCKETS
_ONES = np.ones(EDGE, np.float32)


@dataclass
class Network:
    """``hidden = tanh(sum of near[i][word at place i] + bias)``, ``P(word) = softmax(hidden . out + prior)``.

    Near vectors of one place on either side replace a first matrix product. ``prior`` starts at the logarithm of the
    words' shares in the corpus, so an untrained network scores like single words.
    """

    near: np.ndarray  # (2 * REACH, inputs, HIDDEN)
    bias: np.ndarray  # (HIDDEN)
    out: np.ndarray  # (HIDDEN, outputs)
    prior: np.ndarray  # (outputs)

    @classmethod
    def fresh(cls, shares: np.ndarray) -> Network:
        """The same start for every task, as networks of different starts could not be averaged."""
        rng = np.random.default_rng(3)
        near = rng.normal(0, 0.3, (2 * REACH, EDGE + 1, HIDDEN))
        out = rng.normal(0, 0.1, (HIDDEN, EDGE))
        return cls(*(part.astype(np.float32) for part in (near, np.zeros(HIDDEN), out, np.log(shares))))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.near.ravel(), self.bias, self.out.ravel(), self.prior])

    @classmethod
    def of_flat(cls, values: np.ndarray) -> Network:
        sizes = np.cumsum([2 * REACH * (EDGE + 1) * HIDDEN, HIDDEN, HIDDEN * EDGE])
        near, bias, out, prior = np.split(values.astype(np.float32), sizes)
        return cls(near.reshape(2 * REACH, EDGE + 1, HIDDEN), bias, out.reshape(HIDDEN, EDGE), prior)

    def _forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hidden layer and a last column of 1, scores of all outputs, none too large for ``exp``) for rows of ``2 * REACH`` neighbours.

        Both are overwritten by the next call: fresh memory for every batch costs more than the products.
        """
        hidden, scores = (part[: len(context)] for part in self._room(len(context)))
        total = self.near[0].take(context[:, 0], axis=0)
        total += self.bias
        for i in range(1, 2 * REACH):
            total += self.near[i].take(context[:, i], axis=0)
        np.tanh(total, out=hidden[:, :HIDDEN])
        # The column of 1 adds the prior.
        np.matmul(hidden, np.concatenate([self.out, self.prior[None]]), out=scores)
        # A hidden value is 1 at most, which bounds the scores.
        if np.abs(self.out).sum(axis=0).max() + np.abs(self.prior).max() > LARGEST:
            scores -= scores.max(axis=1, keepdims=True)
        return hidden, scores

    def _room(self, rows: int) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_kept") or len(self._kept[0]) < rows:
            self._kept = np.ones((rows, HIDDEN + 1), np.float32), np.empty((rows, EDGE), np.float32)
        return self._kept

    def log_probability(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of each word, given its neighbours."""
        _, scores = self._forward(context)
        own = scores[np.arange(len(word)), word]
        return own - np.log(np.exp(scores, out=scores) @ _ONES)

    def train(self, context: np.ndarray, word: np.ndarray, rate: float) -> None:
        """One step of gradient descent on the mean log-loss of the rows."""
        hidden, error = self._forward(context)
        np.exp(error, out=error)
        # Each row over its sum, less 1 at the word, is the error; the sums divide the small factors instead.
        share = 1 / (error @ _ONES)
        error[np.arange(len(word)), word] -= 1 / share
        back = error @ self.out.T
        back *= share[:, None]
        step = np.float32(rate / len(word))
        change = (hidden * share[:, None]).T @ error
        self.out -= step * change[:HIDDEN]
        back *= 1 - np.square(hidden[:, :HIDDEN])
        self.prior -= step * change[HIDDEN]
        self.bias -= step * back.sum(axis=0)
        # Rows of the same neighbour at the same place add up.
        columns = np.ascontiguousarray(back.T, np.float64)
        for i in range(2 * REACH):
            ids = context[:, i].astype(np.intp)
            sums = [np.bincount(ids, column, EDGE + 1) for column in columns]
            self.near[i] -= step * np.array(sums, np.float32).T


def word_hash(word: bytes) -> int:
    """64 bits that stand for a word; the lower half gives its bucket."""
    return (xxhash.xxh32_intdigest(word) << 32 | zlib.crc32(word)) - (1 << 63)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """``word_hash`` of each: hashing a word anew costs less than looking it up among very many."""
    upper, lower = (np.fromiter(map(half, words), np.int64, len(words)) for half in (xxhash.xxh32_intdigest, zlib.crc32))
    return (upper << 32 | lower) ^ np.int64(-1 << 63)


class Vocabulary:
    """Numbers of words: 0 to ``FREQUENT - 1`` for the frequent ones (words or hashes), then the bucket of a hash."""

    def __init__(self, frequent: list[str] | list[int]):
        known = np.array([word if isinstance(word, int) else word_hash(word.encode()) for word in frequent], np.int64)
        self.order = np.argsort(known)
        self.known = known[self.order]

    def hashed(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, all documents one after another; words of each document)."""
        words = [(text or "").encode().lower().split() for text in texts]
        lengths = np.array([len(own) for own in words], np.int64)
        return word_hashes(list(chain.from_iterable(words))), lengths

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        out = (FREQUENT + (hashes & 0xFFFFFFFF) % BUCKETS).astype(np.uint8)
        if len(self.known):
            place = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
            found = self.known[place] == hashes
            out[found] = self.order[place[found]]
        return out

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(neighbours of each word, the word, its document), all documents one after another."""
        return self.around(*self.hashed(texts))

    def around(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat, doc = self.numbers(hashes), np.repeat(np.arange(len(lengths)), lengths)
        # Every document stands between its own edges.
        padded = np.full(len(flat) + 2 * REACH * len(lengths), EDGE, np.uint8)
        place = np.arange(len(flat)) + REACH * (2 * doc + 1)
        padded[place] = flat
        sides = [*range(-REACH, 0), *range(1, REACH + 1)]
        return np.stack([padded[place + side] for side in sides], axis=1) if len(flat) else np.empty((0, 2 * REACH), np.uint8), flat, doc


def word_counts(rows: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts: words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, by their hashes."""

    def count(batches):
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                counts.update((text or "").encode().lower().split())
            if len(counts) > COUNTED_WORDS:
                yield from _counted(counts)
        yield from _counted(counts)

    return rows.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter):
    names = list(counts)
    for at in range(0, len(names), 10_000):
        part = names[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(word_hashes(part)), pa.array([counts[w] for w in part], pa.int64())], ["word", "n"])
    counts.clear()


@dataclass
class Model:
    """``counts`` has ``(word, n)`` of the whole corpus, by hash; ``rest`` the words in each bucket."""

    frequent: list[int]
    network: Network
    counts: DataFrame
    rest: list[int]

    def share(self) -> Column:
        """Logarithm of a word's share in its bucket, from columns ``word`` and ``n``.

        A word that the corpus does not have (null ``n``) gets the share of one seen once beside all others.
        """
        total = F.element_at(F.array(*map(F.lit, self.rest)), _bucket() + 1)
        return F.when(F.col("n").isNull(), -F.log(total + 1.0)).otherwise(F.log(F.col("n") / total))


def _bucket() -> Column:
    return (F.col("word").bitwiseAND(0xFFFFFFFF) % BUCKETS).cast("int")


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", passes: int = PASSES) -> Model:
    """Train on the whole corpus.

    Word counts of all documents give the vocabulary and the shares of its entries. In every pass each task trains the
    network on all windows of its documents; the tasks' weights, weighted by their windows, are summed in Spark and
    averaged. The driver holds one network (some 11,000 numbers), whatever the corpus; the counts of all words stay a
    table, from which ``score`` takes the share of every word within its bucket.
    """
    ship(df.sparkSession)
    rows = id_and_text(df, id_col, text_col)
    counts = staged(word_counts(rows), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = [row.word for row in top]
    known = F.col("word").isin(frequent) if top else F.lit(False)
    rest = {row.bucket: row.n for row in counts.where(~known).groupBy(_bucket().alias("bucket")).agg(F.sum("n").alias("n")).collect()}
    others = [rest.get(i, 0) for i in range(BUCKETS)]
    shares = np.array([row.n for row in top] + [0] * (FREQUENT - len(top)) + others, float) + 0.5
    network = Network.fresh(shares / shares.sum())
    for _ in range(passes):
        start = network.flat()

        def train(batches, start=start):
            own, vocabulary, windows = Network.of_flat(start), Vocabulary(frequent), 0
            rng = np.random.default_rng(1)
            for batch in slices(batches):
                context, word, _ = vocabulary.windows(batch.column("text").to_pylist())
                order = rng.permutation(len(word))
                for at in range(0, len(word), BATCH):
                    part = order[at : at + BATCH]
                    own.train(context[part], word[part], RATE)
                windows += len(word)
            if windows:
                values = own.flat().astype(np.float64) * windows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(values)), pa.int32()), pa.array(values), pa.array([windows] * len(values), pa.int64())],
                    ["place", "value", "windows"],
                )

        sums = rows.mapInArrow(train, "place int, value double, windows long").groupBy("place").agg(
            (F.sum("value") / F.sum("windows")).alias("value")
        )
        averaged = staged(sums, "network").orderBy("place").collect()
        if averaged:
            network = Network.of_flat(np.array([row.value for row in averaged]))
    return Model(frequent, network, counts, others)


class Listing:
    """Lists the words in buckets of some documents: each different word once, by its hash, in the order they turn up."""

    def __init__(self):
        self.places: dict[int, int] = {}
        self.words = 0

    def add(self, hashes: np.ndarray) -> tuple[np.ndarray, int, list[int]]:
        """(places of the words as 32-bit integers, place of the first new one, the new ones)."""
        places, first = self.places, len(self.places)
        different, which = np.unique(hashes, return_inverse=True)
        different = different.tolist()
        found = np.array([places.setdefault(word, len(places)) for word in different], "<i4")
        self.words += len(hashes)
        new = [word for word, place in zip(different, found.tolist(), strict=True) if place >= first]
        return found[which] if len(hashes) else found, first, new

    def full(self, listed: int, together: int) -> bool:
        return len(self.places) >= listed or self.words >= together


def _with_shares(id_col: str):
    def add(docs: pa.Table, shares: pa.Table) -> pa.Table:
        """Adds the shares of their words to the scores of the documents of one list."""
        share = np.zeros(shares.num_rows)
        share[shares.column("place").to_numpy()] = shares.column("share").to_numpy()
        more = [share[np.frombuffer(own, "<i4")].sum() for own in docs.column("places").to_pylist()]
        n, total = docs.column("n_words").to_numpy(), docs.column("total").to_numpy() + np.array(more, float)
        return pa.table(
            [docs.column("id").combine_chunks(), pa.array(n, pa.int64()), pa.array(total), pa.array(total / np.maximum(n, 1), mask=n == 0)],
            [id_col, "n_words", "log_likelihood", "per_word"],
        )

    return add


def score(
    df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", listed: int = LISTED, together: int = TOGETHER,
    piece: int = 2 << 20,
) -> DataFrame:
    """``(<id_col>, n_words, log_likelihood, per_word)`` of each row, over its whole text.

    ``log_likelihood`` is the sum over all words of the logarithm of their probability given ``REACH`` words on either
    side, ``per_word`` its mean. The probability is the network's for a frequent word; for any other it is the
    network's for the bucket times the word's share in the bucket, by the counts of the whole corpus. Null and empty
    texts have 0 words, a sum of 0 and a null mean; null ids stay null; repeated rows are scored each; an empty table
    gives an empty one.

    The counts grow with the corpus and are joined, never sent to the tasks: documents scored one after another share
    a list of their different words, each list is joined with the counts, and the shares come back to its documents.
    ``listed``, ``together`` and ``piece`` say when a list is closed and how much text is looked at at a time.
    """
    ship(df.sparkSession)
    frequent, network = model.frequent, model.network

    def run(batches):
        vocabulary, listing = Vocabulary(frequent), Listing()
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, limit=piece):
            hashes, n = vocabulary.hashed(batch.column("text").to_pylist())
            context, word, doc = vocabulary.around(hashes, n)
            found = np.empty(len(word))
            for at in range(0, len(word), BATCH):
                found[at : at + BATCH] = network.log_probability(context[at : at + BATCH], word[at : at + BATCH])
            total = np.bincount(doc, found, minlength=batch.num_rows).astype(float)
            if listing.full(listed, together):
                listing, number = Listing(), number + 1
            rare = word >= FREQUENT
            places, first, new = listing.add(hashes[rare])
            ends = np.cumsum(np.bincount(doc[rare], minlength=batch.num_rows))[:-1]
            # The first document of a piece brings its new words.
            words = [new, *[[]] * (batch.num_rows - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(batch.num_rows, number), pa.int64()), batch.column("id"), pa.array(n, pa.int64()), pa.array(total),
                    pa.array([own.tobytes() for own in np.split(places, ends)], pa.binary()), pa.array(np.full(batch.num_rows, first), pa.int32()),
                    pa.array(words, pa.list_(pa.int64())),
                ],
                ["list", "id", "n_words", "total", "places", "first", "new"],
            )

    docs = staged(
        id_and_text(df, id_col, text_col).mapInArrow(
            run, "list long, id long, n_words long, total double, places binary, first int, new array<long>"
        ),
        "scored", compression="zstd",
    )
    words = docs.where(F.size("new") > 0).select(F.col("list").alias("of"), "first", F.posexplode("new").alias("at", "word"))
    shares = words.join(model.counts, "word", "left").select("of", (F.col("first") + F.col("at")).alias("place"), model.share().alias("share"))
    return docs.drop("first", "new").groupBy("list").cogroup(shares.groupBy("of")).applyInArrow(
        _with_shares(id_col), f"`{id_col}` long, n_words long, log_likelihood double, per_word double"
    )


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` with a network trained on the same documents."""
    return score(df, fit(df, id_col, text_col), id_col, text_col)
