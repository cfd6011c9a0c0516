"""How the filters of a corpus act together: truth-table survival words.

Five pass-or-fail filters are judged once per document. A document then becomes one
32-bit word: bit T says whether it survives the subset T of filters (a subset is the sum
of its filters' bits). Words are counted bit by bit with carry-save adders: three words
of one weight give a sum word of that weight and a carry word of twice the weight, until
at most two words of a weight are left, so 32 counts cost a few logical operations per
document. The counts of surviving documents per subset, part and label tell everything
about all 120 orders of the filters: what a step keeps and removes, what it would have
removed had it come first, and each filter's sum over all orders.

Texts are read once, in Arrow batches; what travels is a row of a few numbers and a
digest per document. Identical texts are found by SHA-256: the smallest id per digest is
a combinable minimum, so a text with a third of all rows costs a row per task, and only
digests held twice or more are joined back (adaptive execution splits a hot one). The
counts are summed per part and label with partial sums.

Filters: A: under ``WORDS`` words; B: under half of the words differ; C: over a fiftieth
of the code points are ``[A-Z]``; D: any of ``[#$%&*|]``; E: the text of a smaller id.
Words are maximal `[^\\x20\\x09-\\x0D]+`, case-sensitive.

Defined results: a null text is the empty text (it fails A, and E if a smaller id has
none either); a null source is the part ``''``, together with empty sources; a row with
a null id has no label and is never a copy, nor is any row a copy of it; rows that repeat
an id are rows of their own and no copies of each other; an id with several label rows
has a label if any of them has it, null labels are none; an empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmfold.llm.common import pick, written

FILTERS = "ABCDE"
WORDS = 200
SUBSETS = 1 << len(FILTERS)
LABELS = ("all", "good", "toxic")
HELD = 4096

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#$%&*|"
_TRAIL = bytes(range(0x80, 0xC0))


def failures(raw: bytes) -> int:
    """Bits of the filters A to D that a UTF-8 text fails."""
    words = raw.split()  # of bytes: at \x20 and \x09-\x0D only
    n, distinct = len(words), len(set(words))
    points = len(raw) - _held(raw, _TRAIL) if not raw.isascii() else len(raw)
    return ((n < WORDS) | (100 * distinct < 50 * n) << 1 | (100 * _held(raw, _UPPER) > 2 * points) << 2
            | (_held(raw, _SYMBOLS) > 0) << 3)


def _held(raw: bytes, which: bytes) -> int:
    return len(raw) - len(raw.translate(None, which))


# Bit T of the word of failure mask m: no filter of subset T fails.
SURVIVAL = np.array([sum(1 << t for t in range(SUBSETS) if not m & t) for m in range(SUBSETS)], dtype=np.uint32)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """Of 32-bit words, how many have each bit: carry-save additions by weight."""
    counts, weight = np.zeros(32, dtype=np.int64), 1
    while len(words):
        carries = []
        while len(words) > 2:
            third = len(words) // 3
            a, b, c, rest = words[:third], words[third:2 * third], words[2 * third:3 * third], words[3 * third:]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, rest])
        for word in words:
            counts += weight * ((int(word) >> np.arange(32)) & 1)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def _judged(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(id, part, fails, digest) of each document."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = pick(docs, id=doc_id, part=source, text=text).select(
        "id", F.coalesce("part", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([failures(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                ["id", "part", "fails", "digest"])

    return rows.mapInArrow(judge, f"id {kind}, part string, fails int, digest binary")


def _survivors(rows: DataFrame) -> DataFrame:
    """(part, label, c0 … c31): survivors of each subset, from (part, fails, good, toxic)."""
    names = [f"c{t}" for t in range(SUBSETS)]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], np.ndarray] = {}

        def out() -> pa.RecordBatch:
            keys, table = list(held), np.array(list(held.values()), dtype=np.int64).reshape(-1, SUBSETS)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 *[pa.array(table[:, t]) for t in range(SUBSETS)]], ["part", "label", *names])

        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            codes = np.asarray(parts.indices)
            words = SURVIVAL[np.asarray(batch.column(1))]
            flags = {"all": np.ones(len(words), bool), "good": np.asarray(batch.column(2)).astype(bool),
                     "toxic": np.asarray(batch.column(3)).astype(bool)}
            for code, part in enumerate(parts.dictionary.to_pylist()):
                for label in LABELS:
                    counts = positional_counts(words[(codes == code) & flags[label]])
                    held[part, label] = held.get((part, label), 0) + counts
            if len(held) > HELD:
                yield out()
        if held:
            yield out()

    sent = rows.select("part", "fails", F.col("good").cast("int"), F.col("toxic").cast("int"))
    counted = sent.mapInArrow(count, "part string, label string, " + ", ".join(f"{c} bigint" for c in names))
    return counted.groupBy("part", "label").agg(*[F.sum(c).alias(c) for c in names])


def _removed_in_all_orders(kept: Column, k: int) -> Column:
    """Filter k's removed documents summed over all orders: each set before it, as often as it comes before."""
    rest, mine = len(FILTERS) - 1, 1 << k
    terms = [factorial(t.bit_count()) * factorial(rest - t.bit_count()) * (kept[t] - kept[t | mine])
             for t in range(SUBSETS) if not t & mine]
    return sum(terms[1:], terms[0])


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """One row per part, order of the filters and step."""
    judged = written(_judged(docs, doc_id, text, source), "judged")
    marks = pick(labels, id=doc_id, quality="quality", toxic="toxic").filter("id is not null").groupBy("id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    first = judged.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = judged.join(marks, "id", "left").join(first.drop("n"), "digest", "left").select(
        "part", F.when(F.col("first") < F.col("id"), F.col("fails") + 16).otherwise(F.col("fails")).alias("fails"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    survivors = _survivors(rows).select("part", "label", F.array(*[f"c{t}" for t in range(SUBSETS)]).alias("kept"))
    parts = survivors.groupBy("part").agg(*[
        F.max(F.when(F.col("label") == label, F.col("kept"))).alias(label) for label in LABELS])

    bit = lambda letter: F.pow(F.lit(2), F.ascii(letter) - 65).cast("int")
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    before = F.aggregate(F.sequence(F.lit(0), F.col("step") - 1), F.lit(0), lambda sum_, i: sum_ + F.when(
        i > 0, bit(F.substring(F.col("filter_order"), i, F.lit(1)))).otherwise(0))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = parts.withColumns({
        "shapley": F.array(*[_removed_in_all_orders(F.col("all"), k) for k in range(len(FILTERS))]),
        "filter_order": F.explode(orders)}).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))).withColumns(
        {"before": before, "bit": bit(letter), "k": F.ascii(letter) - 65})

    def lost(counts: str) -> Column:
        return F.get(counts, F.col("before")) - F.get(counts, F.col("before") + F.col("bit"))

    every = SUBSETS - 1
    return steps.select(
        "part", "filter_order", "step", F.get("all", F.col("before") + F.col("bit")).alias("kept"),
        lost("all").alias("removed"),
        (F.get("all", F.lit(0)) - F.get("all", F.col("bit")) - lost("all")).alias("redundant"),
        (F.get("all", every - F.col("bit")) - F.get("all", F.lit(every))).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("k")).alias("shapley"))
