"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the character n-grams of the lower-cased text (a space at either end), hashed to 2 ** 18 places; a text has a feature or
not. The log-count ratio of a feature is log((p + 0.5) / (P + 1)) - log((q + 0.5) / (Q + 1)), where p of P toxic and q of Q other
training texts have it. A feature whose ratio is within three standard errors of zero, sqrt(1 / (p + 0.5) + 1 / (q + 0.5)) each, is
left out. On the rest, a logistic regression is fitted whose inputs are the ratios of the features that a text has.

The counts cover all training rows: every task adds up its own, and sends a row per feature. The regression is fitted, in one task, on
at most `fit_rows` training texts of each label, those with the smallest hashes of id and text: a documented bound. Scoring is a map
stage over all texts; the model in it has at most 2 ** 18 weights.

Defined results: null and empty texts score by the intercept alone; without training labels of both kinds every score is the share
of toxic ones among the training labels (0.5 without labels); several labels of one document: the highest holds; rows with a null key or label do not
train; repeated rows train and score each; texts of any length are scored whole; an empty table gives an empty result; other columns are
not read, so their names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import slices, stored

BITS, SIZES = 18, (3, 4, 5)
#: Standard errors that a log-count ratio must differ from zero by.
MIN_ERRORS = 3.0
#: Most training texts of each label that the regression is fitted on.
FIT_ROWS = 2000
#: Characters of a text that are hashed at a time; n-grams that cross a cut are hashed too.
PART = 1 << 20

FACTORS = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1]


def places(text: str, sizes: tuple[int, ...] = SIZES, bits: int = BITS) -> np.ndarray:
    """Sorted places of the n-grams of a text."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), "<u4")
    found = []
    for start in range(0, len(codes), PART):
        part = codes[start : start + PART + max(sizes) - 1]
        for n in sizes:
            if len(part) >= n:
                h = np.full(len(part) - n + 1, n, np.uint32)
                for j in range(n):
                    h ^= part[j : len(part) - n + 1 + j]
                    h *= np.uint32(FACTORS[j % len(FACTORS)])
                h ^= h >> np.uint32(15)
                h *= np.uint32(FACTORS[0])
                found.append(h >> np.uint32(32 - bits))
    seen = np.zeros(1 << bits, bool)
    for h in found:
        seen[h] = True
    return np.flatnonzero(seen)


def held_out(key: Column, parts: int = 5) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == 0, F.lit(False))


def counts(train: DataFrame) -> DataFrame:
    """place, p, q: training texts of either label that have the feature; place -1 counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2, (1 << BITS) + 1), np.int64)
        for rows, values in slices(batches):
            for toxic, text in zip(rows.column("toxic").to_pylist(), values):
                table[toxic, places(text)] += 1
                table[toxic, -1] += 1
        at = np.flatnonzero(table.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at == 1 << BITS, -1, at)), pa.array(table[1, at]), pa.array(table[0, at])], names=["place", "p", "q"])

    return train.select("toxic", "text").mapInArrow(run, "place long, p long, q long").groupBy("place").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def ratios(table: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Log-count ratio of each place, 0 for those left out. `table` holds p and q per place, `total` the numbers of texts."""
    some = table + 0.5
    share = some / (total[:, None] + 1.0)
    ratio = np.log(share[0]) - np.log(share[1])
    return np.where(np.abs(ratio) >= MIN_ERRORS * np.sqrt((1 / some).sum(axis=0)), ratio, 0.0)


def fitted(texts: list[str], toxic: np.ndarray, ratio: np.ndarray, steps: int = 80, rate: float = 0.1, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights per place (already multiplied by the ratio) and intercept, by gradient steps with a rate per weight."""
    has = [x[ratio[x] != 0] for x in map(places, texts)]
    row, place = np.repeat(np.arange(len(has)), [len(x) for x in has]), np.concatenate(has)
    used, place = np.unique(place, return_inverse=True)
    scale, balance = ratio[used], np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum()))
    weights, squares, intercept, square = np.zeros(len(used)), np.full(len(used), 1e-8), 0.0, 1e-8
    for _ in range(steps):
        margin = np.bincount(row, (weights * scale)[place], len(has)) + intercept
        error = (sigmoid(margin) - toxic) * balance
        slope = np.bincount(place, error[row], len(used)) * scale + decay * weights
        squares += slope * slope
        weights -= rate * slope / np.sqrt(squares)
        square += error.sum() ** 2
        intercept -= rate * error.sum() / np.sqrt(square)
    out = np.zeros(len(ratio))
    out[used] = weights * scale
    return out, float(intercept)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def lowest(rows: DataFrame, n: int) -> DataFrame:
    """draw, toxic, text of the rows with the `n` lowest draws, equal rows once. The border is found without the texts."""
    border = rows.select("draw").distinct().orderBy("draw").limit(n).agg(F.max("draw")).first()[0]
    return rows.filter(F.col("draw") <= border).groupBy("draw", "toxic").agg(F.first("text").alias("text"))


def train_model(train: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """Weights per place and intercept from `train` (draw, toxic, text)."""
    table, total = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    for place, p, q in counts(train).toLocalIterator():  # 2 ** BITS rows at most
        if place < 0:
            total[:] = p, q
        else:
            table[:, place] = p, q
    if not total.all():
        share = total[0] / total.sum() if total.sum() else 0.5
        return np.zeros(1 << BITS), float(np.clip(np.log(share / (1 - share)) if 0 < share < 1 else 50.0 * (2 * share - 1), -50, 50))
    ratio = train.sparkSession.sparkContext.broadcast(ratios(table, total))
    some = reduce(DataFrame.unionByName, [lowest(train.filter(F.col("toxic") == label), fit_rows) for label in (0, 1)])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["toxic", "draw"])
        weights, intercept = fitted(rows["text"].tolist(), rows["toxic"].to_numpy(), ratio.value)
        at = np.flatnonzero(weights)
        return pd.DataFrame({"place": np.append(at, -1), "weight": np.append(weights[at], intercept)})

    model = some.groupBy().applyInPandas(fit, "place long, weight double")
    weights, intercept = np.zeros(1 << BITS), 0.0
    for place, weight in model.collect():
        if place < 0:
            intercept = weight
        else:
            weights[place] = weight
    return weights, intercept


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted. Only labels of documents that are not held out are learned from."""
    source = docs.select(docs[key].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    named = labels.select(labels[key].alias("doc_id"), labels[label].cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    named = named.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out(F.col("doc_id")))
    # Labels grow with the documents, so both are shuffled at any size.
    train = stored(source.join(named.hint("merge"), "doc_id").select(F.xxhash64("doc_id", "text").alias("draw"), "toxic", "text"), "toxicity-train")
    model = source.sparkSession.sparkContext.broadcast(train_model(train, fit_rows))
    schema = T.StructType([source.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = model.value
        for rows, values in slices(batches):
            margins = np.array([weights[places(v)].sum() for v in values]) + intercept
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").combine_chunks(), pa.array(sigmoid(margins))], names=["doc_id", "score"])

    scored = source.mapInArrow(run, schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
