"""Language ID by string kernels with Nyström landmarks and kernel ridge regression.

The kernel of two texts is the number of byte n-grams of 1 to 4 bytes that both hold
(presence, blended over the lengths), divided by the root of the product of their own
numbers. A bounded sample of labelled texts gives the landmarks and the training rows.
With landmark kernels K_m and training kernels K_n, one ridge regression per language
against the rest is solved in the Nyström feature space. Scoring a batch of texts is one
sparse matrix product: the batch's presence matrix, as bins and row starts, times the
landmarks' presence times the weights. As the product is associative, landmarks times
weights is formed once for all batches.

N-grams are kept in a table of ``BINS`` bins per length (exact for 1 and 2 bytes,
hashed beyond). Whole texts are read; training texts are those of at most
``TRAIN_CHARS`` characters (the beginnings of longer ones where a language has no
other), at most ``TRAIN_ROWS`` per language, in order of a hash of their id. All
languages are learnt; beyond ``LANGUAGES`` ones the bound per language shrinks.

Defined results: a null text, and one without a letter, is ``und`` with score 0; null
labels are not learnt from; a null id is neither held out nor learnt from; of several texts
of one id and label the smallest is learnt from; without any
labelled row every text is ``und``; repeated rows are scored alike; the smaller
language code wins a tie; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmfold.llm.common import id_remainder, pick, written

LENGTHS = (1, 2, 3, 4)
BINS = 1 << 16
LANDMARKS = 256
TRAIN_ROWS = 500
TRAIN_CHARS = 20_000
LANGUAGES = 64
RIDGE = 1e-3
SHARPNESS = 8.0
UNKNOWN = "und"
SALTS = 64
BATCH = 64
FOLDS = 5


def present(text: str) -> np.ndarray:
    """Sorted bins of the n-grams of a lower-cased text, all lengths blended."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    seen = np.zeros(len(LENGTHS) * BINS, dtype=bool)
    code = raw.copy()
    for k, length in enumerate(LENGTHS):
        if length > len(raw):
            break
        if length > 1:
            code = (code[:-1] << np.uint32(8)) | raw[length - 1:]
        bins = code if length <= 2 else (code * np.uint32(2654435761)) >> np.uint32(16)
        seen[k * BINS + bins] = True
    return np.flatnonzero(seen)


class Model:
    """Weights per bin and language; ``languages`` is sorted."""

    def __init__(self, texts: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> None:
        self.languages = sorted(set(labels))
        rows = [present(t) for t in texts]
        marks = rows[::max(1, len(rows) // landmarks)]
        held = np.zeros((len(marks), len(LENGTHS) * BINS), dtype=bool)
        for k, bins in enumerate(marks):
            held[k, bins] = True
        size, mark_size = (np.sqrt([max(len(b), 1) for b in x]) for x in (rows, marks))
        kernel = np.array([held[:, bins].sum(axis=1) for bins in rows]) / size[:, None] / mark_size[None, :]
        values, vectors = np.linalg.eigh(kernel[::max(1, len(rows) // landmarks)])
        used = values > 1e-8 * values.max()
        whiten = vectors[:, used] / np.sqrt(values[used])
        features = kernel @ whiten
        goal = np.where(np.array(labels)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        # Languages weigh alike, however many rows each has.
        weight = 1 / np.array([labels.count(x) for x in labels])
        gram = features.T @ (features * weight[:, None]) + ridge * np.eye(features.shape[1])
        solved = np.linalg.solve(gram, features.T @ (goal * weight[:, None]))
        per_mark = whiten @ solved / mark_size[:, None]
        self.weights = np.zeros((len(LENGTHS) * BINS, len(self.languages)), dtype=np.float32)
        for bins, weight in zip(marks, per_mark):
            self.weights[bins] += weight

    def scores(self, texts: list[str]) -> np.ndarray:
        """Of each text a share per language; together 1. Every text has an n-gram."""
        rows = [present(t) for t in texts]
        sizes = np.array([len(bins) for bins in rows])
        starts = np.cumsum(sizes) - sizes
        value = np.add.reduceat(self.weights[np.concatenate(rows)], starts, axis=0, dtype=np.float64) / np.sqrt(sizes)[:, None]
        power = np.exp(SHARPNESS * (value - value.max(axis=1, keepdims=True)))
        return power / power.sum(axis=1, keepdims=True)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model | None:
    """A model from the labelled rows of the learning folds; None without any."""
    able = pick(docs, id=id_col, text=text_col, lang=lang_col).filter(
        (id_remainder(F.col("id"), FOLDS) != 0) & F.col("lang").isNotNull())
    # Texts are looked through once; what is chosen from has none.
    slim = written(able.filter(F.regexp_like("text", F.lit(r"\p{L}"))).select(
        "lang", "id", (F.length("text") > chars).alias("long"), F.xxhash64("id").alias("at")), "labelled")
    # Every language is learnt: of many ones fewer texts each, and long texts where it has no short ones.
    langs = slim.groupBy("lang").agg(F.min("long").alias("long"))
    rows = max(1, min(rows, rows * LANGUAGES // max(1, langs.count())))
    known = slim.join(langs, ["lang", "long"]).withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(SALTS)))
    for group in (["lang", "salt"], ["lang"]):  # the first of each salt, then of these
        nth = F.row_number().over(Window.partitionBy(*group).orderBy("at", "id"))
        known = known.withColumn("nth", nth).filter(F.col("nth") <= rows)
    chosen = known.select("id").distinct().collect()
    if not chosen:
        return None
    # At most LANGUAGES * TRAIN_ROWS ids, or one for each language.
    ids = docs.sparkSession.createDataFrame([(r["id"],) for r in chosen], "id bigint")
    texts = able.filter(F.regexp_like("text", F.lit(r"\p{L}"))).join(F.broadcast(ids), "id")
    sample = texts.groupBy("id", "lang").agg(F.min(F.substring("text", 1, chars)).alias("text"))
    sample = sample.orderBy(F.xxhash64("id"), "id", "lang").collect()
    return Model([r["text"] for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``held_out``, ``lang_pred``, ``score``."""
    held = F.coalesce(id_remainder(F.col("id"), FOLDS) == 0, F.lit(False))
    rows = pick(docs, id=id_col, text=text_col).select("id", held.alias("held_out"), "text")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, shares = _predicted(batch["text"], shared.value)
            yield pd.DataFrame({"id": batch["id"].astype("Int64"), "held_out": batch["held_out"], "lang_pred": names, "score": shares})

    out = rows.mapInPandas(score, "id bigint, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def _predicted(texts: pd.Series, model: Model | None) -> tuple[np.ndarray, np.ndarray]:
    """Language and share of each text of a batch."""
    names, shares = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
    able = [k for k, t in enumerate(texts) if model is not None and t and any(map(str.isalpha, t))]
    for start in range(0, len(able), BATCH):
        some = able[start:start + BATCH]
        found = model.scores([texts.iloc[k] for k in some])
        best = found.argmax(axis=1)
        names[some], shares[some] = np.array(model.languages, dtype=object)[best], found[np.arange(len(some)), best]
    return names, shares


def keep_known(docs: DataFrame, model: Model | None, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The input rows, with all their columns, whose language is told with at least this score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def told(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            names, shares = _predicted(texts, shared.value)
            yield pd.Series((names != UNKNOWN) & (shares >= least), dtype=bool)

    return docs.filter(F.pandas_udf(told, "boolean")(F.col(f"`{text_col}`")))
