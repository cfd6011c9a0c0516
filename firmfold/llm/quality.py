"""Quality rules: a threshold table compiled into one projection.

Every metric is a built-in expression over one row, so judging a table is a
single scan without shuffle and without user functions.

Defined results: a null or empty text has no word and fails; rows are judged one
by one, so repeated rows and ids, ties and null ids are kept as they are; an
empty table gives an empty table. Other columns of the input are not touched and
may have any name, as only the named ones are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmfold.llm.common import SPACE, bound, pick, words

WINDOW = 8

# Frequent function words of the four languages.
STOP_WORDS = """
    the of and to in a is that for it was with be by on are as from at this
    der die und den das von zu mit ist im ein eine sich des nicht auf
    le la les et de du un une est que dans en pour qui pas il elle
    el los las y del se por con una al lo su para mi
""".split()


@dataclass(frozen=True)
class Threshold:
    """A metric's accepted range; ``None`` leaves a side open."""

    name: str
    metric: str
    at_least: float | None = None
    at_most: float | None = None


# n_words and repeat_ratio are the base; the others are the method's own verdict.
BASE = (Threshold("too_short", "n_words", at_least=20),
        Threshold("repeats", "repeat_ratio", at_most=0.3))
DEFAULT = (Threshold("word_length", "mean_word_chars", at_least=2.0, at_most=20.0),
           Threshold("symbols", "symbol_ratio", at_most=0.1),
           Threshold("stop_words", "stop_ratio", at_least=0.02),
           Threshold("dup_lines", "dup_line_ratio", at_most=0.5))


def _repeat_words(w: Column) -> Column:
    """Words inside 8-word windows that the text holds twice or more, from a bound word array.

    Windows are compared by a 64-bit hash. Starts of repeated windows are sorted
    by position; each start covers its own words up to the next start.
    """
    n = F.size(w)

    def starts(hashes: Column) -> Column:
        """Sorted positions of the windows whose hash occurs more than once."""
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(r: Column) -> Column:
            last = F.size(r) - 1
            same = F.filter(r, lambda x, k: (
                ((k > 0) & (F.get(r, k - 1)["h"] == x["h"])) | ((k < last) & (F.get(r, k + 1)["h"] == x["h"]))))
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        return bound(ranked, repeated)

    def covered(s: Column) -> Column:
        gaps = F.transform(s, lambda p, k: F.least(F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, g: total + g)

    def count(hashes: Column) -> Column:
        distinct = F.size(F.array_distinct(hashes))
        return F.when(distinct < F.size(hashes), bound(starts(hashes), covered)).otherwise(F.lit(0).cast("bigint"))

    # Hashes of 1, 2, 4 and then 8 words, each joined from two of half the length.
    def longer(h: Column, by: int) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + by)))

    single = F.transform(w, lambda x: F.xxhash64(x))
    hashes = bound(single, lambda a: bound(longer(a, 1), lambda b: bound(longer(b, 2), lambda c: longer(c, 4))))
    whole = F.slice(hashes, F.lit(1), n - WINDOW + 1)
    return F.when(n <= WINDOW, F.lit(0).cast("bigint")).otherwise(bound(whole, count))


def _counts(text: Column) -> Column:
    """All counts of one text as a struct; the words are split once."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(f"[^{SPACE}]")))

    def of_words(w: Column) -> Column:
        stop = F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.size(stop).cast("bigint").alias("n_stop_words"),
            _repeat_words(w).alias("n_repeat_words"))

    def of_lines(line: Column) -> Column:
        return F.struct(F.size(line).cast("bigint").alias("n_lines"),
                        (F.size(line) - F.size(F.array_distinct(line))).cast("bigint").alias("n_dup_lines"))

    return F.struct(bound(words(text), of_words).alias("w"), bound(lines, of_lines).alias("l"),
                    F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"))


def _metrics(get: Callable[[str], Column]) -> dict[str, Column]:
    n = F.greatest(get("n_words"), F.lit(1))
    return {
        "n_words": get("n_words"),
        "repeat_ratio": get("n_repeat_words") / n,
        "mean_word_chars": get("word_chars") / n,
        "symbol_ratio": get("n_symbols") / n,
        "stop_ratio": get("n_stop_words") / n,
        "dup_line_ratio": get("n_dup_lines") / F.greatest(get("n_lines"), F.lit(1)),
    }


def _failed(rules: tuple[Threshold, ...], get: Callable[[str], Column]) -> Column:
    """Names of the broken rules, in the order of the table."""
    metrics = _metrics(get)
    marks = []
    for rule in rules:
        value, broken = metrics[rule.metric], F.lit(False)
        if rule.at_least is not None:
            broken = broken | (value < rule.at_least)
        if rule.at_most is not None:
            broken = broken | (value > rule.at_most)
        marks.append(F.when(broken, F.lit(rule.name)))
    return F.array_compact(F.array(*marks)).cast("array<string>")


def _flat(counts: Column) -> dict[str, Column]:
    """The single counts of a ``_counts`` struct."""
    out = {k: counts["w"][k] for k in ("n_words", "word_chars", "n_stop_words", "n_repeat_words")}
    return out | {k: counts["l"][k] for k in ("n_lines", "n_dup_lines")} | {"n_symbols": counts["n_symbols"]}


def judge(docs: DataFrame, rules: tuple[Threshold, ...] = DEFAULT, base: tuple[Threshold, ...] = BASE,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, counts, ``failed`` (names of broken rules), ``base_failed``, ``kept``."""
    counted = pick(docs, id=id_col, text=text_col).select("id", _counts(F.coalesce("text", F.lit(""))).alias("c"))
    flat = counted.select("id", *[c.alias(k) for k, c in _flat(F.col("c")).items()])
    broken_base, broken = _failed(base, F.col), _failed(rules, F.col)
    return flat.select(
        F.col("id").alias(id_col), *flat.columns[1:], (F.size(broken_base) > 0).alias("base_failed"),
        F.concat(broken_base, broken).alias("failed"),
        ((F.size(broken_base) == 0) & (F.size(broken) == 0)).alias("kept"))


def keep_good(docs: DataFrame, rules: tuple[Threshold, ...] = DEFAULT, base: tuple[Threshold, ...] = BASE,
              text_col: str = "text") -> DataFrame:
    """The input rows that pass every rule, with all their columns."""
    # One expression that evaluates the counts once: a filter over a projected struct would be
    # pushed below the projection, and its counts evaluated anew for every rule.
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.filter(bound(_counts(text), lambda c: F.size(_failed(base + rules, _flat(c).__getitem__)) == 0))
