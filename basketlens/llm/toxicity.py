"""Toxicity: a character n-gram linear classifier on naive Bayes log-count ratios.

Texts are lower-cased; every run of white space counts as one space. The features
of a text are its distinct character n-grams of the given sizes, hashed to
2 ** FEATURE_BITS buckets. Over the labelled training rows each feature gets the
ratio

    r = log((toxic rows with it + 1) / (toxic rows + 2)) - log((clean rows with it + 1) / (clean rows + 2))

Features whose rates in both classes differ by less than MIN_Z standard errors
are left out. A logistic regression on the remaining features, each worth r when
present, gives the weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import worker_cache, written

SIZES = (4, 5, 6)
FEATURE_BITS = 20
#: Labelled rows that a fit reads at most, chosen by a hash of doc_id.
TRAIN_ROWS = 20_000
MIN_Z = 4.0
MIN_ROWS = 4
#: Share of rows that a score must reach to count as toxic.
THRESHOLD = 0.3
#: Texts, and characters, handled together within a task.
TEXTS_AT_ONCE = 64
CHARS_AT_ONCE = 1 << 18
#: Odd multipliers of the n-gram hash.
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D, 0xFD7046C5, 0xB55A4F09], np.uint32)
_SPACES = re.compile(r"\s+")


def _groups(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CHARS_AT_ONCE or len(held) >= TEXTS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _hashes(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the bucket at each place of all texts, and whether an n-gram lies there."""
    shown = [f" {_SPACES.sub(' ', t.lower())} " for t in texts]
    codes = np.frombuffer("".join(shown).encode("utf-32-le", "surrogatepass"), np.uint32)
    left = np.concatenate([np.arange(len(s), 0, -1) for s in shown]) if shown else np.zeros(0, np.int64)
    total = np.zeros(len(codes), np.uint32)
    for k in range(max(SIZES)):
        if len(codes) <= k:
            break
        total = total[:len(codes) - k] + codes[k:] * FACTORS[k]
        if k + 1 in SIZES:
            mixed = (total ^ (total >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(k)
            yield mixed >> np.uint32(32 - FEATURE_BITS), left[:len(mixed)] > k


def _owners(texts: list[str]) -> np.ndarray:
    return np.repeat(np.arange(len(texts)), [len(_SPACES.sub(" ", t.lower())) + 2 for t in texts])


def features(texts: list[str], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of the buckets marked in ``wanted``."""
    worker_cache("toxicity")  # nothing is kept; another operator's memory is released
    rows, buckets, base = [], [], 0
    for some in _groups(texts):
        owner = _owners(some)
        for bucket, there in _hashes(some):
            at = np.flatnonzero(wanted[bucket] & there)
            rows.append(owner[at].astype(np.int64) + base)
            buckets.append(bucket[at].astype(np.int64))
        base += len(some)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique((np.concatenate(rows) << FEATURE_BITS) | np.concatenate(buckets))
    return pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1)


def _places(batches: Iterator[pa.RecordBatch], buckets: np.ndarray, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(places of a text's features in ``buckets``, label) for rows (text, label), a few texts at a time."""
    for whole in batches:
        for start in range(0, whole.num_rows, TEXTS_AT_ONCE):
            batch = whole.slice(start, TEXTS_AT_ONCE)
            row, bucket = features(batch.column(0).to_pylist(), wanted)
            edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
            at = np.searchsorted(buckets, bucket)
            lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([lists, batch.column(1)], names=["at", "label"])


@dataclass
class Model:
    """Log-odds: ``intercept`` plus the weight of each bucket present."""

    intercept: float
    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def score(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        rows, buckets = features(texts, table != 0)
        logit = self.intercept + np.bincount(rows, weights=table[buckets], minlength=len(texts))[:len(texts)]
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))

    def table(self) -> np.ndarray:
        out = np.zeros(1 << FEATURE_BITS)
        out[self.buckets] = self.weights
        return out


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents outside the held-out fold.

    An id with several labels is toxic if one of them says so; of several texts
    with one id the smallest is read. NULL ids and NULL labels are left out.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # at most `rows` pairs of numbers
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from the labelled rows; with one class or none the model is its smoothed share."""
    train = written(training_rows(docs, labels, rows), "toxicity_rows")
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sum(n for t, n in sizes.items() if t >= 0.5), sum(n for t, n in sizes.items() if t < 0.5)
    if not toxic or not clean:
        return Model(float(np.log((toxic + 1) / (clean + 1))))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << FEATURE_BITS), np.int64)
        every = np.ones(1 << FEATURE_BITS, bool)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                is_toxic = np.array(batch.column(1).to_pylist()) >= 0.5
                row, bucket = features(batch.column(0).to_pylist(), every)
                for label in (0, 1):
                    counts[label] += np.bincount(bucket[is_toxic[row] == bool(label)], minlength=1 << FEATURE_BITS)
        found = np.flatnonzero(counts.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[1][found], pa.int64()), pa.array(counts[0][found], pa.int64())],
                                         names=["bucket", "n_toxic", "n_clean"])

    share = (F.col("n_toxic") + F.col("n_clean")) / (toxic + clean)
    error = F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
    kept = (train.select("text", "toxic").mapInArrow(counted, "bucket bigint, n_toxic bigint, n_clean bigint")
            .groupBy("bucket").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
            .where((F.col("n_toxic") + F.col("n_clean") >= MIN_ROWS) & (F.abs(F.col("n_toxic") / toxic - F.col("n_clean") / clean) >= MIN_Z * error))
            .collect())  # at most 2 ** FEATURE_BITS rows
    kept.sort(key=lambda r: r["bucket"])
    if not kept:
        return Model(float(np.log((toxic + 1) / (clean + 1))))
    buckets = np.array([r["bucket"] for r in kept], np.int64)
    ratio = np.array([np.log((r["n_toxic"] + 1) / (toxic + 2)) - np.log((r["n_clean"] + 1) / (clean + 2)) for r in kept])
    wanted = np.zeros(1 << FEATURE_BITS, bool)
    wanted[buckets] = True

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _places(batches, buckets, wanted)

    @F.udf(VectorUDT())
    def vector(at):
        return Vectors.sparse(len(buckets), at, ratio[at].tolist())

    rows_in = written(train.select("text", "toxic").mapInArrow(found, "at array<int>, label double"), "toxicity_features")
    data = rows_in.select(vector("at").alias("features"), "label").persist()
    # weights shrink towards the ratios' own scale, so features aren't rescaled to unit variance
    model = LogisticRegression(regParam=1e-3, standardization=False, maxIter=60).fit(data)
    data.unpersist()
    weights = model.coefficients.toArray() * ratio
    used = weights != 0
    return Model(float(model.intercept), buckets[used], weights[used])


def with_score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic is likelier) and ``predicted``.

    NULL and empty texts get the score of a text without features. Columns of
    ``docs`` called ``score`` or ``predicted`` are replaced. One row per row; nothing
    is shuffled, and only the text is read for a score.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model.table())  # 2 ** FEATURE_BITS numbers

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = ["" if t is None else t for t in batch.tolist()]
            yield pd.Series(np.concatenate([model.score(values[a:a + TEXTS_AT_ONCE], weights.value) for a in range(0, len(values), TEXTS_AT_ONCE)] or [np.zeros(0)]))

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    return docs.select(*kept, scored("text").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on ``labels`` and score every text: doc_id, held_out, score, predicted.

    One row per row: repeated rows score alike, NULL and empty texts as a text without
    features, a NULL doc_id is not held out. Without labels of both classes every text has the
    smoothed share of the one there is (0.5 without any). Very long texts are scored whole,
    one at a time with others up to CHARS_AT_ONCE; memory is in proportion to the text. Other
    columns are not read; an empty table gives no rows.
    """
    model = fit(docs, labels)
    scored = with_score(docs.select("doc_id", "text"), model, threshold)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with their own columns, whatever
    these are called. See ``score_documents`` for NULLs, repeated rows and empty tables."""
    scored = with_score(docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select("__row", "text"), fit(docs, labels), threshold)
    return scored.where("predicted = 0").select("__row.*")
