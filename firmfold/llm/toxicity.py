"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

A text's features are the n-grams of 3 to 6 characters that its lower-cased form, with
single blanks, holds. From a bounded sample of labelled texts, every n-gram gets its
log-count ratio, smoothed; the ``FEATURES`` with the surest ratios (ratio over its
standard error) are kept and multiplied by their ratio, and a ridge-penalised logistic
regression is fitted on them. N-grams are compared by 64-bit hashes of their characters
and length; a small bit table only skips those that no feature can equal.

The sample holds at most ``TRAIN_ROWS`` texts per label, of at most ``TRAIN_CHARS``
characters, in order of a hash of the id, from labelled documents of the learning folds.
It is chosen from slim rows of documents that are there and short enough; every task
keeps its first ``TRAIN_ROWS`` per label, and only chosen texts are fetched. Whole texts
are scored.

Defined results: a null text is scored as an empty one, which gets the base rate that
the intercept gives; a null label is not learnt from, a null id is neither held out nor
learnt from; without both labels every score is 0; repeated rows are scored alike; of
several texts under one id the one with the smallest hash is learnt, once for each of
its labels; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.llm.common import id_remainder, pick, written

LENGTHS = (3, 4, 5, 6)
FEATURES = 4_000
LEAST_TEXTS = 3
TRAIN_ROWS = 1500
TRAIN_CHARS = 8_000
RIDGE = 0.3
STEPS = 150
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
_TABLE = 1 << 20
_FACTOR = np.uint64(0xD1342543DE82EF95)  # odd, so that no character's bits are lost


def grams(text: str | None, length: int) -> np.ndarray:
    """Hashes of the n-grams of one length, repeated as in the text."""
    flat = f" {' '.join((text or '').lower().split())} "
    raw = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if len(raw) < length:
        return np.empty(0, dtype=np.uint64)
    n = len(raw) - length + 1
    code = np.full(n, length, dtype=np.uint64)
    for k in range(length):
        code *= _FACTOR
        code += raw[k:k + n]
    return code


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)


class Model:
    """Sorted feature codes with their weights, and the intercept."""

    def __init__(self, texts: list[str | None], labels: list[int]) -> None:
        toxic = np.array(labels, dtype=bool)
        positive, negative = toxic.sum(), (~toxic).sum()
        kept_codes, kept_ratio, rows, columns, base = [], [], [], [], 0
        for length in LENGTHS:
            sets = [np.unique(grams(t, length)) for t in texts]
            owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
            codes, column = np.unique(np.concatenate(sets), return_inverse=True)
            column, sets = column.astype(np.int32), None
            with_, all_ = np.bincount(column, weights=toxic[owner]), np.bincount(column)
            without = all_ - with_
            ratio = np.log((with_ + 1) / (positive + 2)) - np.log((without + 1) / (negative + 2))
            sure = np.abs(ratio) / np.sqrt(1 / (with_ + 1) + 1 / (without + 1))
            sure[all_ < LEAST_TEXTS] = 0
            best = np.sort(np.argsort(-sure, kind="stable")[:FEATURES // len(LENGTHS)])
            best = best[sure[best] > 0]
            place = np.full(len(codes), -1, dtype=np.int32)
            place[best] = np.arange(len(best), dtype=np.int32)
            hit = place[column] >= 0
            rows.append(owner[hit])
            columns.append(place[column[hit]] + np.int32(base))
            kept_codes.append(codes[best])
            kept_ratio.append(ratio[best])
            base += len(best)
        self.codes, ratio = np.concatenate(kept_codes), np.concatenate(kept_ratio)
        weights, self.intercept = _logistic(np.concatenate(rows), np.concatenate(columns), ratio, toxic)
        self.weights = weights * ratio
        order = np.argsort(self.codes)
        self.codes, self.weights = self.codes[order], self.weights[order]
        self.maybe = np.zeros(_TABLE, dtype=bool)
        self.maybe[_slots(self.codes)] = True

    def score(self, text: str | None) -> float:
        total = self.intercept
        for length in LENGTHS:
            codes = grams(text, length)
            codes = np.unique(codes[self.maybe[_slots(codes)]])
            if len(codes) and len(self.codes):
                at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
                total += self.weights[at[self.codes[at] == codes]].sum()
        return float(1 / (1 + np.exp(-np.clip(total, -40, 40))))


def _logistic(rows: np.ndarray, columns: np.ndarray, scale: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by accelerated gradient steps; the intercept is free."""
    n, d = len(goal), len(scale)
    values = scale[columns].astype(np.float32)
    weights, bias = np.zeros(d), 0.0
    ahead, ahead_bias, momentum = weights, bias, 1.0
    # The largest curvature, from a few power steps.
    v = np.ones(d) / np.sqrt(max(d, 1))
    for _ in range(8):
        u = np.bincount(rows, values * v[columns], n)
        v = np.bincount(columns, values * u[rows], d)
        norm = np.linalg.norm(v) or 1.0
        v /= norm
    step = 1 / (0.25 * (norm + n) + RIDGE)
    for _ in range(STEPS):
        margin = np.bincount(rows, values * ahead[columns], n) + ahead_bias
        error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - goal
        new = ahead - step * (np.bincount(columns, values * error[rows], d) + RIDGE * ahead)
        new_bias = ahead_bias - step * error.sum()
        later = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = new + (momentum - 1) / later * (new - weights)
        ahead_bias = new_bias + (momentum - 1) / later * (new_bias - bias)
        weights, bias, momentum = new, new_bias, later
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
          label_col: str = "toxic", rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model | None:
    """A model from the labelled rows of the learning folds; None without both labels."""
    learnt = pick(labels, id=label_id_col, toxic=label_col).filter(
        (id_remainder(F.col("id"), FOLDS) != HELD_OUT) & F.col("toxic").isin(0, 1)).distinct()
    texts = pick(docs, id=id_col, text=text_col).filter(F.coalesce(F.length("text"), F.lit(0)) <= chars)
    texts = texts.withColumn("mark", F.xxhash64("text"))
    slim = learnt.join(texts.select("id", "mark"), "id").groupBy("id", F.col("toxic").cast("int").alias("toxic")).agg(
        F.min("mark").alias("mark"))
    slim = written(slim, "toxicity_known")
    chosen = [r for label in (0, 1) for r in slim.filter(F.col("toxic") == label).orderBy(
        F.xxhash64("id"), "id").limit(rows).collect()]
    if len({r["toxic"] for r in chosen}) < 2:
        return None
    # At most 2 * rows slim rows, whatever the size of the tables.
    known = docs.sparkSession.createDataFrame(chosen, slim.schema)
    sample = texts.join(F.broadcast(known), ["id", "mark"]).groupBy("id", "toxic").agg(
        F.min("text").alias("text")).orderBy(F.xxhash64("id"), "id", "toxic").collect()
    if len({r["toxic"] for r in sample}) < 2:
        return None
    return Model([r["text"] for r in sample], [r["toxic"] for r in sample])


def judge(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``held_out``, ``score``, ``predicted``."""
    held = F.coalesce(id_remainder(F.col("id"), FOLDS) == HELD_OUT, F.lit(False))
    rows = pick(docs, id=id_col, text=text_col).select("id", held.alias("held_out"), "text")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learnt = shared.value
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"].astype("Int64"), "held_out": batch["held_out"], "score": [
                learnt.score(t) if learnt else 0.0 for t in batch["text"]]})

    out = rows.mapInPandas(score, "id bigint, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
