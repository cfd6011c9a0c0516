"""Embedding near-dedup with spherical-cap filters from random product codes.

Vectors are scaled to unit length and turned by a fixed random rotation, then cut into
``PARTS`` parts, each with a codebook of random unit vectors. Every combination of
codes is a filter direction. A vector belongs to all filters whose direction it exceeds
a threshold along; they are list-decoded part by part, cutting combinations that cannot
reach the threshold any more. Vectors that share a filter are compared in double
precision. The number of filters follows the number of vectors, and the threshold is
set so that a vector has about ``EXPECTED`` filters, so filters hold equally many
vectors at every size. Where fewer than ``ENOUGH`` are exceeded, as happens to vectors
far from all codes, the threshold is lowered to the best ``ENOUGH``. A pair of cosine 0.95 shares several of its filters; the recall
against brute force is measured in the tests.

Equal vectors are one class with a count. Filters with more than ``CHUNK`` vectors are
dealt onto pairs of chunks, so no task holds more than two chunks. A pair that shares
several filters counts in the smallest of them. A task returns one row per vector, its
number of links and one vector it hangs together with, never the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths are never linked; rows with
repeated ids count as rows; null ids take part and name no component, so a group of
null ids only has a null component and its ``kept`` is false; an empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

from statistics import NormalDist
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.llm.common import pick, written
from firmfold.llm.components import components

COSINE = 0.95
PARTS = 2
EXPECTED = 16
ENOUGH = 16
VECTORS_PER_FILTER = 4
CHUNK = 512
SEED = 20240229


class Code:
    """Filters for unit vectors of one length."""

    def __init__(self, length: int, filters: int, parts: int = PARTS, expected: float = EXPECTED) -> None:
        draw = np.random.default_rng([SEED, length])
        self._turn = np.linalg.qr(draw.standard_normal((length, length)))[0]
        parts = min(parts, length)
        self._bounds = np.linspace(0, length, parts + 1).astype(int)
        each = max(2, round(filters ** (1 / parts)))
        self._books = []
        for a, b in zip(self._bounds, self._bounds[1:]):
            book = draw.standard_normal((each, b - a))
            self._books.append(book / np.linalg.norm(book, axis=1, keepdims=True))
        self._total, self._enough = each ** parts, ENOUGH
        # A direction's parts have length 1, so the sum along them has variance parts / length.
        share = min(0.5, expected / self._total)
        self._least = NormalDist().inv_cdf(1 - share) * np.sqrt(parts / length)
        self._step = 0.25 * np.sqrt(parts / length)

    def filters(self, units: np.ndarray) -> list[np.ndarray]:
        """Of each row, the sorted numbers of its filters."""
        turned = units @ self._turn
        scores = [turned[:, a:b] @ book.T for a, b, book in zip(self._bounds, self._bounds[1:], self._books)]
        tops = np.array([s.max(axis=1) for s in scores])
        return [self._exceeding([s[row] for s in scores], tops[:, row]) for row in range(len(units))]

    def _exceeding(self, scores: list[np.ndarray], tops: np.ndarray) -> np.ndarray:
        """All filters along which one vector exceeds the threshold, lowered until there are enough."""
        least, enough = self._least, min(self._enough, self._total)
        while True:
            numbers, sums = np.zeros(1, dtype=np.int64), np.zeros(1)
            for part, score in enumerate(scores):
                rest = tops[part + 1:].sum()
                able = np.flatnonzero(score + sums.max(initial=-np.inf) + rest >= least)
                grid = sums[:, None] + score[able][None, :]
                old, new = np.nonzero(grid + rest >= least)
                numbers, sums = numbers[old] * len(score) + able[new], grid[old, new]
            if len(numbers) >= enough:
                if least < self._least:  # lowered too far: exactly enough of them
                    numbers = numbers[np.argsort(-sums, kind="stable")[:enough]]
                return np.sort(numbers)
            least -= self._step


def _units(vectors: pd.Series) -> np.ndarray:
    matrix = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)  # no overflow of the squares
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _decoded(classes: DataFrame, filters: int) -> DataFrame:
    """(class, n, length, unit, filters) of each distinct vector."""
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: dict[int, Code] = {}
        for batch in batches:
            for length, rows in batch.groupby(batch["vector"].map(len)):
                if length not in codes:
                    codes[length] = Code(length, filters)
                units = _units(rows["vector"])
                yield pd.DataFrame({"class": rows["class"].to_numpy(), "n": rows["n"].to_numpy(), "length": length,
                                    "unit": [u.tobytes() for u in units], "filters": codes[length].filters(units)})

    return classes.mapInPandas(decode, "class bigint, n bigint, length int, unit binary, filters array<bigint>")


def _met(decoded: DataFrame) -> DataFrame:
    """Rows of each filter, dealt onto pairs (low, high) of its chunks; single rows are left out."""
    slim = decoded.select("length", F.explode("filters").alias("filter"))
    room = slim.groupBy("length", "filter").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    room = room.select("length", "filter", F.ceil(F.col("held") / CHUNK).alias("chunks"))
    each = decoded.withColumn("filter", F.explode("filters")).join(room, ["length", "filter"])
    mine = F.pmod(F.xxhash64("class"), F.col("chunks"))
    dealt = each.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    return dealt.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")}).drop("other", "chunks")


def _compared(met: DataFrame, cosine: float) -> DataFrame:
    """(class, links, partner) per vector and task: rows linked first here, and one it hangs together with."""
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        here, low, high = (int(rows[c].iloc[0]) for c in ("filter", "low", "high"))
        units = np.frombuffer(b"".join(rows["unit"]), dtype=np.float64).reshape(len(rows), -1)
        mine = rows["mine"].to_numpy()
        near = units @ units.T >= cosine
        near[np.arange(len(rows)), np.arange(len(rows))] = False
        if low < high:  # pairs of one chunk meet in that chunk's own task
            near &= mine[:, None] != mine[None, :]
        lists = [f[f < here] for f in rows["filters"]]
        if any(map(len, lists)):
            known, column = np.unique(np.concatenate(lists), return_inverse=True)
            held = np.zeros((len(rows), len(known)), dtype=np.float32)
            held[np.repeat(np.arange(len(rows)), [len(f) for f in lists]), column] = 1
            first = near & (held @ held.T < 0.5)
        else:
            first = near
        group = np.arange(len(rows))
        while True:  # the smallest position of each connected part
            least = np.minimum(group, np.where(near, group[None, :], len(rows)).min(axis=1, initial=len(rows)))
            least = least[least]
            if (least == group).all():
                break
            group = least
        names = rows["class"].to_numpy()
        out = pd.DataFrame({"class": names, "links": first @ rows["n"].to_numpy(), "partner": names[group]})
        return out[(out["links"] > 0) | (out["class"] != out["partner"])]

    return met.groupBy("length", "filter", "low", "high").applyInPandas(
        compare, "class bigint, links bigint, partner bigint")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id``, ``kept``."""
    rows = pick(vectors, id=id_col, vector=vector_col)
    sound = F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "vector", lambda x: x != 0), F.lit(False))
    marked = rows.select("id", "vector", F.when(sound, F.xxhash64("vector")).alias("class"))
    members = written(marked.select("id", "class"), "members")
    classes = marked.filter("class is not null").groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
    classes = written(classes, "classes")
    decoded = written(_decoded(classes, max(64, classes.count() // VECTORS_PER_FILTER)), "decoded")
    compared = written(_compared(_met(decoded), cosine), "compared")
    counts = compared.groupBy("class").agg(F.sum("links").alias("links"))
    parts = components(compared.filter("class <> partner").select(F.col("class").alias("a"), F.col("partner").alias("b")))
    about = classes.select("class", "n").join(counts, "class", "left").join(
        parts.withColumnRenamed("node", "class"), "class", "left").select(
        "class", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class").alias("component"))
    linked = members.join(about, "class", "left")
    least = linked.filter("class is not null").groupBy("component").agg(F.min("id").alias("component_id"))
    out = linked.join(least, "component", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
