"""Toxicity as ordered severity grades: a cumulative-link regression on sparse text features."""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, by_place, pick, slices, staged

#: The model is fitted on at most this many labelled documents (the first in the order of a hash of their id).
MAX_LABELLED = 12_000
#: It learns from at most this many features, the ones that tell the classes apart best, each in MIN_DOCUMENTS or more.
MAX_FEATURES, MIN_DOCUMENTS, MIN_GAIN = 800, 5, 16.0
#: Grades: 0 for documents that are not toxic; toxic ones split into as many by their number of toxic words.
SEVERITIES = 3
#: Log-odds from which a feature counts as a toxic word when training documents are graded.
STRONG = 2.0
#: Documents are toxic from this probability of any grade above 0 on.
LIMIT = 0.5
STEPS, RATE, PENALTY = 600, 0.05, 1e-5
MEMO_WORDS = 200_000


def features_of(lang: str, word: str) -> list[str]:
    """A word by itself, and its beginnings within the language of the document."""
    return [f"={word}", *(f"{lang}^{word[:n]}" for n in range(2, min(6, len(word)) + 1))]


def words_of(text: str) -> list[str]:
    """Lower-case words without the ASCII punctuation around them."""
    return [word.strip(string.punctuation) for word in text.lower().split()]


@dataclass
class Model:
    """P(grade >= k) = sigmoid(weights . features - thresholds[k - 1]): one weight vector for all thresholds.

    Weights and thresholds are bounded by ``MAX_FEATURES`` and ``SEVERITIES``, whatever the corpus. ``constant`` is
    used instead where the labels do not have both classes: the share of toxic ones, or 0 without any labels.
    """

    features: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(SEVERITIES))
    constant: float | None = 0.0

    def exceed(self, counts: np.ndarray, places: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
        """P(grade >= k) of ``size`` rows and every k, from the counts of features at (row, place)."""
        if self.constant is not None:
            return np.repeat([[self.constant] + [0.0] * (SEVERITIES - 1)], size, axis=0)
        score = np.bincount(rows, np.log1p(counts) * self.weights[places], minlength=size)
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


class Finder:
    """Finds a model's features in documents, with a memo of the words of each language."""

    def __init__(self, features: dict[str, int]):
        self.features = features
        self.memos: dict[str, Memo] = {}

    def _found(self, lang: str):
        return lambda word: tuple(place for name in features_of(lang, word) if (place := self.features.get(name)) is not None)

    def hits(self, lang: str | None, text: str | None) -> list[tuple[int, ...]]:
        """The features of each word that has any."""
        lang = lang or ""
        if lang not in self.memos:
            if len(self.memos) >= 64:
                self.memos.clear()
            self.memos[lang] = Memo(self._found(lang), MEMO_WORDS)
        return [found for found in map(self.memos[lang].__getitem__, words_of(text or "")) if found]


def _counts(hits: list[tuple[int, ...]]) -> Counter:
    return Counter(place for found in hits for place in found)


def labelled(docs: DataFrame, labels: DataFrame, max_labelled: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """At most ``max_labelled`` labelled documents with different texts."""
    chosen = (
        pick(labels, id=(id_col, "long"), toxic=("toxic", "int")).dropna()
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    )
    rows = _rows(docs, id_col, text_col, lang_col)
    # The broadcast has max_labelled rows of two numbers at most.
    return staged(rows.join(F.broadcast(chosen), "id").dropDuplicates(["lang", "text"]), "labelled")


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    if lang_col in docs.columns:
        return pick(docs, id=(id_col, "long"), text=(text_col, "string"), lang=(lang_col, "string"))
    return pick(docs, id=(id_col, "long"), text=(text_col, "string")).withColumn("lang", F.lit(""))


def _document_counts(batches):
    """(feature, documents that have it, toxic ones among them) of a task."""
    have, toxic = Counter(), Counter()
    for batch in slices(batches):
        for lang, text, label in zip(*(batch.column(name).to_pylist() for name in ("lang", "text", "toxic")), strict=True):
            own = {name for word in set(words_of(text or "")) for name in features_of(lang or "", word)}
            have.update(own)
            if label > 0:
                toxic.update(own)
    names = list(have)
    for at in range(0, len(names), 50_000):
        part = names[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([have[n] for n in part], pa.int64()), pa.array([toxic[n] for n in part], pa.int64())],
            ["name", "have", "toxic"],
        )


def fit(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Fit the regression on a bounded sample of labelled documents.

    Features are counted and chosen in Spark; the driver gets ``MAX_FEATURES`` names and the sparse counts of the
    sample. A toxic document's grade is the quantile of its number of toxic words among the toxic ones of the sample.
    """
    sample = labelled(docs, labels, max_labelled, id_col, text_col, lang_col)
    total, toxic = sample.agg(F.count("*"), F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0))).first()
    if not total or not toxic or toxic == total:
        return Model(constant=toxic / total if total else 0.0)
    have, among = F.col("have"), F.col("toxic")
    odds = F.log((among + 0.5) / (toxic - among + 0.5)) - F.log((have - among + 0.5) / (total - toxic - have + among + 0.5))

    def part(seen, of_feature, of_class):
        return F.when(seen > 0, 2 * seen * F.log(seen * total / (of_feature * of_class))).otherwise(0.0)

    # The log-likelihood ratio of "has the feature" and "is toxic" against their independence.
    gain = (
        part(among, have, toxic) + part(have - among, have, total - toxic)
        + part(toxic - among, total - have, toxic) + part(total - toxic - have + among, total - have, total - toxic)
    )
    chosen = (
        sample.mapInArrow(_document_counts, "name string, have long, toxic long")
        .groupBy("name").agg(F.sum("have").alias("have"), F.sum("toxic").alias("toxic"))
        .where(F.col("have") >= MIN_DOCUMENTS)
        .withColumn("odds", odds).withColumn("gain", gain).where(F.col("gain") >= MIN_GAIN)
        .orderBy(F.desc("gain"), "name").limit(MAX_FEATURES).select("name", "odds").collect()
    )
    if not chosen:
        return Model(constant=toxic / total)
    features = {row.name: i for i, row in enumerate(chosen)}
    strong = [row.odds > STRONG for row in chosen]

    def sparse(batches):
        finder = Finder(features)
        for batch in slices(batches):
            hits = [finder.hits(*row) for row in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            counts = [_counts(own) for own in hits]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("toxic"),
                    pa.array([sum(any(strong[place] for place in found) for found in own) for own in hits], pa.int64()),
                    pa.array([list(own) for own in counts], pa.list_(pa.int32())),
                    pa.array([list(own.values()) for own in counts], pa.list_(pa.int32())),
                ],
                ["id", "toxic", "toxic_words", "places", "counts"],
            )

    rows = sample.mapInArrow(sparse, "id long, toxic int, toxic_words long, places array<int>, counts array<int>").orderBy("id").collect()
    x = np.zeros((len(rows), len(features)), np.float32)
    for i, row in enumerate(rows):
        x[i, row.places] = np.log1p(row.counts)
    is_toxic = np.array([row.toxic > 0 for row in rows])
    words = np.array([row.toxic_words for row in rows])
    bounds = np.quantile(words[is_toxic], np.arange(1, SEVERITIES) / SEVERITIES)
    grade = np.where(is_toxic, 1 + np.searchsorted(bounds, words, "left"), 0)
    return _regress(x, grade, features)


def _regress(x: np.ndarray, grade: np.ndarray, features: dict[str, int]) -> Model:
    """Maximum likelihood with a small ridge, by Adam. Thresholds stay in order: each is the one before plus exp(gap)."""
    weights, first, gaps = np.zeros(x.shape[1]), 1.0, np.zeros(SEVERITIES - 1)
    moments = [np.zeros(len(weights) + SEVERITIES), np.zeros(len(weights) + SEVERITIES)]
    for step in range(1, STEPS + 1):
        thresholds = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        above = 1 / (1 + np.exp(np.clip(thresholds - (x @ weights.astype(np.float32))[:, None], -30, 30)))
        # P(grade) = P(>= grade) - P(>= grade + 1), with 1 and 0 beyond the ends.
        padded = np.concatenate((np.ones((len(x), 1)), above, np.zeros((len(x), 1))), axis=1)
        at = np.arange(len(x))
        high, low = padded[at, grade], padded[at, grade + 1]
        likely = np.maximum(high - low, 1e-9)
        slope_high, slope_low = high * (1 - high) / likely, low * (1 - low) / likely
        by_score = (slope_low - slope_high) / len(x)
        by_threshold = np.zeros(SEVERITIES)
        np.add.at(by_threshold, np.maximum(grade - 1, 0), np.where(grade > 0, slope_high, 0.0) / len(x))
        np.add.at(by_threshold, np.minimum(grade, SEVERITIES - 1), -np.where(grade < SEVERITIES, slope_low, 0.0) / len(x))
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate((by_score.astype(np.float32) @ x + PENALTY * weights, [tail[0]], tail[1:] * np.exp(gaps)))
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.98 * moments[1] + 0.02 * gradient**2
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.98**step)) + 1e-8)
        weights, first, gaps = weights - move[: len(weights)], first - move[len(weights)], gaps - move[len(weights) + 1 :]
    return Model(features, weights, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))), None)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(<id_col>, severity, p_toxic, grade, toxic, kept)`` of each row, over its whole text.

    ``severity`` is the expected grade, ``p_toxic`` the probability of any grade above 0, ``grade`` the likeliest one;
    ``toxic`` where ``p_toxic`` is at least one half, ``kept`` otherwise. Null and empty texts have no features; null
    languages are one of their own; null ids stay null; repeated rows are scored each; an empty table gives an empty one.
    """

    def run(batches):
        finder = Finder(model.features)
        for batch in slices(batches):
            above = _above(model, finder, batch.column("lang").to_pylist(), batch.column("text").to_pylist())
            chance = -np.diff(np.concatenate((np.ones((len(above), 1)), above, np.zeros((len(above), 1))), axis=1), axis=1)
            toxic = above[:, 0] >= LIMIT
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(chance.argmax(axis=1), pa.int32()), pa.array(toxic), pa.array(~toxic)],
                [id_col, "severity", "p_toxic", "grade", "toxic", "kept"],
            )

    return _rows(docs, id_col, text_col, lang_col).mapInArrow(
        run, f"`{id_col}` long, severity double, p_toxic double, grade int, toxic boolean, kept boolean"
    )


def _above(model: Model, finder: Finder, langs: list[str | None], texts: list[str | None]) -> np.ndarray:
    """P(grade >= k) of each document."""
    found = [_counts(finder.hits(*row)) for row in zip(langs, texts, strict=True)]
    rows = np.repeat(np.arange(len(found)), [len(own) for own in found])
    places = np.array([place for own in found for place in own], np.int64)
    counts = np.array([n for own in found for n in own.values()], np.float64)
    return model.exceed(counts, places, rows, len(found))


def clean_rows(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows, with all their columns, that are not toxic: no shuffle, no join by id.

    A null text has nothing toxic and stays; rows that share an id or a text are judged each; names of columns may differ
    in case only; an empty table gives an empty one.
    """
    place, own = docs.columns.index(text_col), by_place(docs)
    lang = docs.columns.index(lang_col) if lang_col in docs.columns else None

    def run(batches):
        finder = Finder(model.features)
        for batch in slices(batches, place):
            langs = [None] * batch.num_rows if lang is None else batch.column(lang).to_pylist()
            yield batch.filter(pa.array(_above(model, finder, langs, batch.column(place).to_pylist())[:, 0] < LIMIT))

    return own.mapInArrow(run, own.schema).toDF(*docs.columns)


def toxicity(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """``predict`` with a model fitted on ``labels (doc_id, toxic)`` of the same documents."""
    return predict(docs, fit(docs, labels, **columns), **columns)
