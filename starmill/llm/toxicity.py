"""Toxicity scores: a linear classifier over character n-grams scaled by log-count ratios.

A text's features are the character n-grams that occur in it, hashed to ``2 ** BITS`` numbers.
Naive Bayes gives each the log ratio of its smoothed document shares among toxic and other texts;
a logistic regression is trained on features scaled by these ratios.  Only features in at least
``LEAST_TEXTS`` texts, and of these the ``MOST_FEATURES`` whose share among toxic texts lies the
most standard deviations off, get a weight, so the model is small and each task holds all of it.

Ratios and features are taken from all labelled texts, one for each distinct doc_id and text.  Each task
counts its texts in a table of all features, which it gives away in packed slices; these are summed
slice by slice, first over a few hundred tasks, then over all.  Texts meet their labels where they are
read, unless the labels are beyond what may be broadcast, and only repeated texts are shuffled.  The
regression takes a bounded sample of them: up to ``SAMPLE`` texts of each label, those with the
smallest hashes, weighted to the shares the labels have over all training rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import stage, text_of
from starmill.operators.keys import BROADCAST_BYTES, measured_bytes

ORDERS = (4, 5, 6)
BITS = 22
SAMPLE = 2000
LEAST_TEXTS = 3
MOST_FEATURES = 1 << 12
FOLDS = 5
#: Features of one slice of counts.
SLICE = 1 << 12
#: Tasks whose slices are summed at once.
TASKS_AT_ONCE = 256
_CHARS_AT_ONCE = 1 << 20
_MULTIPLIER = np.uint32(0x9E3779B1)


@dataclass
class Model:
    """``weights`` of the hashed n-grams ``features``; ``bias`` is the margin of an empty text."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


# --- features --------------------------------------------------------------------------


def _hashed(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of a text, one array per order."""
    base = np.uint32(16777619)
    rolled = codes
    for order in range(2, max(ORDERS) + 1):
        if len(codes) < order:
            return
        rolled = rolled[:-1] * base + codes[order - 1 :]
        if order in ORDERS:
            yield ((rolled ^ np.uint32(order)) * _MULTIPLIER) >> np.uint32(32 - BITS)


def _codes(text: str) -> np.ndarray:
    """Code points in lower case, with a space at both ends so that edges of words show."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _hits(text: str, wanted: np.ndarray | None) -> np.ndarray:
    """Distinct features of a text; with ``wanted`` (a flag per feature) only those."""
    codes, overlap = _codes(text), max(ORDERS) - 1
    found = [np.empty(0, dtype=np.uint32)]
    for at in range(0, max(1, len(codes) - overlap), _CHARS_AT_ONCE):
        for hashes in _hashed(codes[at : at + _CHARS_AT_ONCE + overlap]):
            found.append(np.unique(hashes) if wanted is None else hashes[wanted[hashes]])
    return np.unique(np.concatenate(found))


# --- training --------------------------------------------------------------------------


def fit(features: np.ndarray, ratio: np.ndarray, texts: list[np.ndarray], labels: np.ndarray, share: float, rounds: int = 150) -> Model:
    """A model over ``features`` (ascending) and their log-count ratios.

    ``texts``: the features of each training text, ``share``: of label 1 among all rows.
    """
    toxic = labels == 1
    prior = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    if not len(features) or not toxic.any() or toxic.all():
        return Model(np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.float32), prior)
    rows = [np.searchsorted(features, t) for t in texts]
    columns = np.concatenate(rows)
    of_row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    weight /= weight.sum()
    weights = _logistic(columns, of_row, ratio[columns], labels.astype(np.float64), weight, len(features), prior, rounds)
    return Model(features, (weights[:-1] * ratio).astype(np.float32), float(weights[-1]))


def _logistic(columns, of_row, values, labels, weight, width, prior, rounds, penalty=1e-4, rate=0.05) -> np.ndarray:
    """Weights and bias of a penalised logistic regression, by Adam over the whole sample."""
    at = np.zeros(width + 1)
    at[-1] = prior
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, rounds + 1):
        margin = np.bincount(of_row, at[columns] * values, minlength=len(labels)) + at[-1]
        error = (_sigmoid(margin) - labels) * weight
        slope = np.append(np.bincount(columns, error[of_row] * values, minlength=width) + penalty * at[:-1], error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        at -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return at


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``labels.toxic`` (0 or 1) from the texts of ``docs``, on the training rows.

    Rows whose label is null take no part; of several labels of one document the largest holds.
    A document that comes in several rows is one training text for each of its texts.  Without labels
    of both
    kinds the model scores every text with the share of label 1 (one half without any label).
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = stage(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    counts = dict(known.groupBy("toxic").count().collect())
    total = sum(counts.values())
    if not total:
        return Model(np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.float32), 0.0)
    digest = F.sha2(text_of(), 256).alias("digest")
    by_id = _bounded(known)
    rows = docs.select("doc_id", digest).join(by_id, "doc_id")
    named = stage(rows.groupBy("doc_id", "digest", "toxic").agg(F.count("*").alias("copies")), "toxic-digests")
    texts_of = dict(named.groupBy("toxic").count().collect())
    order = (F.xxhash64("doc_id", "digest"), "doc_id", "digest")
    named, repeated = named.drop("copies"), _bounded(named.where("copies > 1").select("doc_id", "digest"))
    chosen = named.where("toxic = 1").orderBy(*order).limit(sample).unionByName(
        named.where("toxic = 0").orderBy(*order).limit(sample)
    )

    # Features are counted and chosen by Spark; the driver sees the chosen ones alone.
    ones, zeros = texts_of.get(1, 0), texts_of.get(0, 0)
    mean = ones / max(ones + zeros, 1)
    texts = docs.select("doc_id", text_of().alias("text"), digest).join(by_id, "doc_id")
    single = texts.join(repeated, ["doc_id", "digest"], "left_anti").select("text", "toxic")
    copied = texts.join(repeated, ["doc_id", "digest"], "left_semi").groupBy("doc_id", "digest").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    counted = single.unionByName(copied.select("text", "toxic")).mapInPandas(_count, "slice int, tasks int, counts binary")
    parts = counted.groupBy("slice", "tasks").applyInPandas(_added, "slice int, counts binary")
    held = parts.groupBy("slice").applyInPandas(_enough, "feature long, n1 long, n0 long")
    expected = (F.col("n1") + F.col("n0")) * mean
    off = F.abs(F.col("n1") - expected) / F.sqrt(expected * (1 - mean) + 1)
    kept = held.orderBy(off.desc(), "feature").limit(MOST_FEATURES)
    kept = sorted((r.feature, r.n1, r.n0) for r in kept.collect())
    features = np.array([k[0] for k in kept], dtype=np.uint32)
    n1, n0 = (np.array([k[i] for k in kept], dtype=np.float64) for i in (1, 2))
    ratio = np.log((n1 + 1) / (ones + 2)) - np.log((n0 + 1) / (zeros + 2))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = np.zeros(1 << BITS, dtype=bool)
        wanted[features] = True
        for batch in batches:
            found = [_hits(text, wanted).astype("<u4").tobytes() for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "digest": batch["digest"], "toxic": batch["toxic"], "features": found})

    # A chosen text that stands in many rows is one row again before it is shuffled.
    texts = docs.select("doc_id", text_of().alias("text"), digest).join(F.broadcast(chosen), ["doc_id", "digest"])
    rows = texts.select("doc_id", "digest", "toxic", "text").mapInPandas(extract, "doc_id long, digest string, toxic int, features binary")
    rows = rows.groupBy("doc_id", "digest", "toxic").agg(F.min("features").alias("features")).toPandas()
    # The order of the rows must not decide the last digits of the weights.
    rows = rows.sort_values(["doc_id", "features"], kind="stable")
    found = [np.frombuffer(f, dtype="<u4") for f in rows["features"]]
    return fit(features, ratio, found, rows["toxic"].to_numpy(), counts.get(1, 0) / total)


def _bounded(table: DataFrame) -> DataFrame:
    """``table``, to be broadcast where its measured size allows it."""
    return F.broadcast(table) if measured_bytes(table) <= BROADCAST_BYTES else table


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many of the task's texts of each label hold a feature: one packed row per slice of features."""
    held = np.zeros((2, 1 << BITS), dtype=np.int32)
    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"], strict=True):
            held[int(label), _hits(text, None)] += 1
    tasks = TaskContext.get().partitionId() // TASKS_AT_ONCE
    for at in range(0, 1 << BITS, SLICE):
        part = held[:, at : at + SLICE]
        if part.any():
            yield pd.DataFrame({"slice": [at // SLICE], "tasks": [tasks], "counts": [_packed(part)]})


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype(np.int64).tobytes(), 1)


def _total(frame: pd.DataFrame) -> np.ndarray:
    return sum(np.frombuffer(zlib.decompress(packed), dtype=np.int64) for packed in frame["counts"]).reshape(2, -1)


def _added(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"slice": frame["slice"].iloc[:1], "counts": [_packed(_total(frame))]})


def _enough(frame: pd.DataFrame) -> pd.DataFrame:
    """A row for each feature of a slice that is in enough texts."""
    total = _total(frame)
    at = np.flatnonzero(total.sum(axis=0) >= LEAST_TEXTS)
    return pd.DataFrame({"feature": at + int(frame["slice"].iloc[0]) * SLICE, "n1": total[1, at], "n0": total[0, at]})


# --- scoring ---------------------------------------------------------------------------


def held_out(key: str = "doc_id"):
    """Whether crc32 of the key as text leaves no remainder by 5; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def margins(texts, model: Model) -> np.ndarray:
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[model.features] = True
    out = np.full(len(texts), model.bias, dtype=np.float64)
    if len(model.features):
        for i, text in enumerate(texts):
            found = _hits(text, wanted)
            out[i] += float(model.weights[np.searchsorted(model.features, found)].sum(dtype=np.float64))
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every row of ``docs``.

    Whole texts are scored; a null text is an empty one.  A null doc_id stays null, repeated rows
    are scored each, an empty table gives no rows.
    """

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(_sigmoid(margins(texts, model)))

    by_text = F.pandas_udf(scored, "double")
    return docs.select("doc_id", held_out().alias("held_out"), by_text(text_of()).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic."""

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(margins(texts, model) < 0)

    return docs.where(F.pandas_udf(scored, "boolean")(text_of()))
