"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams (operator 1).

A document is the set of its hashed features: words, pairs of neighbours, and
pairs with one or two words between (skip-grams). Learning walks once or more
over a bounded sample of labelled documents in one task, with a learning rate of
its own for every feature, which falls as the feature is seen, and an L1 term
that keeps features without evidence at exactly zero. What is left is a short
sparse vector. Its size is bounded by the number of hash values, so it is
broadcast, and scoring is a map over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratestar.llm.memory import tidy_batches
from ratestar.llm.package import ship
from ratestar.llm.words import Words, byte_class, mix, slices, split_words

#: `[^\x00-\x26\x28-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text: letters, digits, apostrophes, all beyond ASCII.
_WORD = byte_class((0x00, 0x26), (0x28, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_U = np.uint64
#: The bias of a model that has learnt from no rows: a score of 0.27.
UNLEARNT_BIAS = -1.0


@dataclass(frozen=True)
class Settings:
    """Parameters of learning. sample_rows and sample_bytes bound the labelled documents learnt from, about, and
    longest_bytes strictly the text of each: longer ones are scored whole like all, but not learnt from."""

    hash_bits: int = 22
    skips: tuple[int, ...] = (1, 2, 3)
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 1.0
    positive_weight: float = 2.0
    passes: int = 3
    sample_rows: int = 24_000
    sample_bytes: int = 192 << 20
    longest_bytes: int = 4 << 20
    seed: int = 17


def features(words: Words, settings: Settings, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the distinct features of each text, in order of the texts; only wanted ones if given."""
    hashes = words.hashes(seed=settings.seed)
    text, last = words.text_of(), words.last()
    parts, numbers = [hashes], [text]
    for skip in settings.skips:
        n = len(hashes) - skip
        if n > 0:
            inside = np.flatnonzero(np.arange(n) + skip < last[:n])
            parts.append(mix(mix(hashes[inside] + _U(skip)) ^ hashes[inside + skip]))
            numbers.append(text[inside])
    number, feature = np.concatenate(numbers), np.concatenate(parts) >> _U(64 - settings.hash_bits)
    if wanted is not None:
        some = np.flatnonzero(wanted[feature])
        number, feature = number[some], feature[some]
    key = np.unique((number.astype(_U) << _U(settings.hash_bits)) | feature)
    return (key >> _U(settings.hash_bits)).astype(np.int64), (key & _U((1 << settings.hash_bits) - 1)).astype(np.int64)


def _of_texts(column: pa.Array, settings: Settings, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a column: first and last row, borders of the rows' features, features."""
    for begin, end in slices(column):
        text, feature = features(split_words(column.slice(begin, end - begin), _WORD, lower=True), settings, wanted)
        yield begin, end, np.searchsorted(text, np.arange(end - begin + 1)), feature


class Ftrl:
    """FTRL-proximal for logistic loss over sets of features."""

    def __init__(self, settings: Settings) -> None:
        self.settings = settings
        size = (1 << settings.hash_bits) + 1  # the last one is the bias, without L1
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.l1 = np.full(size, settings.l1)
        self.l1[-1] = 0.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z = self.settings, self.z[at]
        step = (s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2
        return np.where(np.abs(z) > self.l1[at], -(z - np.sign(z) * self.l1[at]) / step, 0.0)

    def learn(self, feature: np.ndarray, label: float) -> None:
        at = np.append(feature, len(self.z) - 1)
        w = self.weights(at)
        gradient = (_sigmoid(w.sum()) - label) * (self.settings.positive_weight if label else 1.0)
        grown = self.n[at] + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.settings.alpha * w
        self.n[at] = grown


def _sigmoid(x: float | np.ndarray) -> float | np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


@dataclass
class Model:
    """Non-zero weights by feature number; the last number of the hash range is the bias."""

    settings: Settings
    feature: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros((1 << self.settings.hash_bits) + 1, dtype=np.float32)
        out[self.feature] = self.weight
        return out


def learn(labelled: DataFrame, text_col: str, label_col: str, order: Column, settings: Settings = Settings()) -> Model:
    """A model from labelled documents (label 0 or 1; rows with other labels are left out).

    `order` is any hash of the rows: where there are more than about
    settings.sample_rows of them, or settings.sample_bytes in their texts, those with the smallest values of it are the
    sample, without texts of over settings.longest_bytes, and it is also the order of learning. Without any rows with label 0
    or 1 nothing speaks against a text: the model scores all alike, under 0.5
    (UNLEARNT_BIAS). The same rows give the same model.
    """
    spark = labelled.sparkSession
    ship(spark)
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), order.cast("long").alias("place"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = rows.where(size <= settings.longest_bytes)
    there = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    share = min(settings.sample_rows / max(1, there["n"]), settings.sample_bytes / max(1, there["bytes"]))
    if share < 1:
        rows = rows.where(F.pmod("place", F.lit(1 << 30)) < int((1 << 30) * share))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, borders, feature in _of_texts(batch.column("text"), settings):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(begin, end - begin), batch.column("place").slice(begin, end - begin),
                     pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(feature.astype(np.int32)))],
                    names=["label", "place", "feature"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [(batch.column("place").to_numpy(), batch.column("label").to_numpy(), batch.column("feature")) for batch in batches]
        if not sample:
            return
        features_ = [x.values.to_numpy(zero_copy_only=False) for _, _, column in sample for x in column]
        label = np.concatenate([x[1] for x in sample])
        model = Ftrl(settings)
        turns = np.argsort(np.concatenate([x[0] for x in sample]), kind="stable")
        for _ in range(settings.passes):
            for i in turns:
                model.learn(features_[i], float(label[i]))
        weight = model.weights(np.arange(len(model.z)))
        used = np.flatnonzero(weight)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weight[used])], names=["feature", "weight"])

    found = (rows.mapInArrow(tidy_batches(vectors), "label int, place long, feature array<int>").repartition(1)
             .mapInArrow(tidy_batches(train), "feature long, weight double").toArrow())
    if not len(found):
        return Model(settings, np.array([1 << settings.hash_bits]), np.array([UNLEARNT_BIAS]))
    return Model(settings, found.column("feature").to_numpy(), found.column("weight").to_numpy())


_dense: dict[int, np.ndarray] = {}


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Adds the probability of label 1, from 0 to 1, for every whole text.

    Null, empty and wordless texts get the score of the bias alone. Other
    columns stay; one named like score_col is replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    key = shared._jbroadcast.id()
    keep = [f for f in docs.schema if f.name != score_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _dense:
            _dense.clear()
            _dense[key] = shared.value.dense()
        weight, settings = _dense[key], shared.value.settings
        wanted = weight != 0
        for batch in batches:
            found = np.empty(len(batch))
            for begin, end, borders, feature in _of_texts(batch.column(batch.schema.get_field_index(text_col)), settings, wanted):
                total = np.concatenate([[0.0], np.cumsum(weight[feature], dtype=np.float64)])
                found[begin:end] = _sigmoid(weight[-1] + total[borders[1:]] - total[borders[:-1]])
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found)], names=[*(f.name for f in keep), score_col])

    return docs.mapInArrow(tidy_batches(run), T.StructType([*keep, T.StructField(score_col, T.DoubleType())]))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's label is kept from learning: crc32 of the id as text, mod 5, is 0. Null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn_from_labels(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model of labels.toxic from the documents that aren't held out.

    The sample is drawn from the labels, so that only its ids (at most about
    settings.sample_rows) are broadcast to the documents. Labels with null id or
    null toxic are left out; repeated equal labels count once, a document labelled both ways is learnt as each. If none is left,
    or none that has a document, all scores are under 0.5, as in `learn`.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic").distinct()
    count = known.count()
    if count > settings.sample_rows:
        share = int((1 << 30) * settings.sample_rows / count)
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    joined = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return learn(joined, "text", "toxic", F.xxhash64("doc_id"), settings)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn_from_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
