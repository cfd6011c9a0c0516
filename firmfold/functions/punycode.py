"""Host names in ASCII form (RFC 3492), as one Column expression.

Browsers and servers agree on the ASCII form of a host, so two spellings of one
site must meet on it. Labels are mapped before they are encoded: characters that
stand for another one (full width, half width, mathematical letters) become that
one, letters followed by combining marks become the composed letter, and invisible
ones go. Hosts that are ASCII already, nearly all of them, never reach mapping or
encoder: the guarding CASE is evaluated row by row.

The JVM's own mapping (``java.net.IDN`` through ``try_reflect``) is not used: Catalyst
takes reflected calls for nondeterministic, so no filter would pass a projection that
holds a host any more; and it turns sharp s into ss, which is another site.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmfold.functions.text import let

# Parameters of RFC 3492, section 5.
BASE, TMIN, TMAX, SKEW, DAMP, INITIAL_BIAS, INITIAL_N = 36, 1, 26, 38, 700, 72, 128
DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"

NON_ASCII = r"[^\x00-\x7F]"

# Dots of other scripts that part labels, and characters that a host is read without.
DOTS = "\u3002\uff0e\uff61"
IGNORED = "".join(map(chr, [0xAD, 0x34F, *range(0x180B, 0x1810), 0x200B, 0x2060, 0x2064, *range(0xFE00, 0xFE10), 0xFEFF]))


@lru_cache(maxsize=None)
def _single_forms() -> tuple[str, str]:
    """Characters that stand for one other character in small letters, and those."""
    pairs = [(c, form) for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.decomposition(c)
             and len(form := unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", c).lower())) == 1 and form != c]
    return "".join(c for c, _ in pairs), "".join(form for _, form in pairs)


@lru_cache(maxsize=None)
def _compositions() -> dict[str, tuple[str, str]]:
    """By combining mark: the letters that it joins, and the composed ones."""
    marks: dict[str, list[tuple[str, str]]] = {}
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        parts = unicodedata.decomposition(c)
        if parts and not parts.startswith("<") and " " in parts and unicodedata.normalize("NFC", c) == c and c.lower() == c:
            letter, mark = (chr(int(x, 16)) for x in parts.split())
            marks.setdefault(mark, []).append((letter, c))
    return {mark: ("".join(a for a, _ in pairs), "".join(b for _, b in pairs)) for mark, pairs in sorted(marks.items())}


def _composed(text: Column) -> Column:
    """Letters and the marks behind them as one character, mark by mark."""
    table = _compositions()
    letters = F.create_map(*[F.lit(x) for mark, (a, _) in table.items() for x in (mark, a)])
    whole = F.create_map(*[F.lit(x) for mark, (_, b) in table.items() for x in (mark, b)])
    start = F.struct(F.lit("").alias("out"), F.lit("").alias("last"))

    def step(acc: Column, c: Column) -> Column:
        joined = F.when(acc["last"] != "", F.call_function("translate", acc["last"], F.coalesce(letters[c], F.lit("")),
                                                           F.coalesce(whole[c], F.lit(""))))
        return let(joined, lambda j: F.when(j != acc["last"], F.struct(acc["out"].alias("out"), j.alias("last"))).otherwise(
            F.struct(F.concat(acc["out"], acc["last"]).alias("out"), c.alias("last"))))

    chars = F.filter(F.split(text, ""), lambda x: x != "")
    return F.aggregate(chars, start, step, lambda acc: F.concat(acc["out"], acc["last"]))


def mapped_host(host: Column) -> Column:
    """Host outside ASCII in the one spelling that is encoded."""
    have, form = _single_forms()
    return let(F.translate(host, have + IGNORED, form), lambda h: F.when(h.rlike(r"\p{M}"), _composed(h)).otherwise(h))


def _idiv(a: Column, b) -> Column:
    return F.floor(a / b).cast("bigint")


def _adapt(delta: Column, points: Column, first: Column) -> Column:
    """Bias after one delta: scale, then count divisions by base - tmin."""
    limit = ((BASE - TMIN) * TMAX) // 2
    damped = _idiv(delta, F.when(first, F.lit(DAMP)).otherwise(F.lit(2)))

    def bias(scaled: Column) -> Column:
        start = F.struct(scaled.alias("d"), F.lit(0).cast("bigint").alias("k"))
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(8)), start,
            lambda acc, _: F.when(
                acc["d"] > limit,
                F.struct(_idiv(acc["d"], BASE - TMIN).alias("d"), (acc["k"] + BASE).alias("k")),
            ).otherwise(acc),
            lambda acc: acc["k"] + _idiv((BASE - TMIN + 1) * acc["d"], acc["d"] + SKEW))

    return let(let(damped, lambda d: d + _idiv(d, points)), bias)


def _varint(delta: Column, bias: Column) -> Column:
    """Delta as generalised variable-length digits."""
    start = F.struct(delta.alias("q"), F.lit("").alias("out"), F.lit(False).alias("done"))

    def digit(d: Column) -> Column:
        return F.substring(F.lit(DIGITS), d.cast("int") + 1, F.lit(1))

    def step(acc: Column, k: Column) -> Column:
        threshold = F.greatest(F.lit(TMIN).cast("bigint"), F.least(F.lit(TMAX).cast("bigint"), k - bias))
        return let(threshold, lambda t: F.when(acc["done"], acc).when(
            acc["q"] < t,
            F.struct(acc["q"].alias("q"), F.concat(acc["out"], digit(acc["q"])).alias("out"),
                     F.lit(True).alias("done")),
        ).otherwise(F.struct(
            _idiv(acc["q"] - t, F.lit(BASE) - t).alias("q"),
            F.concat(acc["out"], digit(t + F.pmod(acc["q"] - t, F.lit(BASE) - t))).alias("out"),
            F.lit(False).alias("done"))))

    steps = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: (i * BASE).cast("bigint"))
    return F.aggregate(steps, start, step, lambda acc: acc["out"])


def _encode_label(label: Column) -> Column:
    chars = F.filter(F.split(label, ""), lambda x: x != "")
    points = F.transform(
        chars, lambda x, i: F.struct(F.conv(F.hex(F.encode(x, "UTF-32")), 16, 10)
                                     .cast("bigint").alias("cp"),
                                     i.cast("bigint").alias("at")))
    basic = F.regexp_replace(label, NON_ASCII, "")
    prefix = F.when(basic != "", F.concat(basic, F.lit("-"))).otherwise("")

    def insert_all(points: Column, n_plain: Column) -> Column:
        start = F.struct(
            F.lit(INITIAL_N).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("i"),
            n_plain.alias("h"), F.lit(INITIAL_BIAS).cast("bigint").alias("bias"), prefix.alias("out"))

        def insert(acc: Column, p: Column) -> Column:
            # Where the character goes in the string of all smaller ones.
            spot = F.size(F.filter(points, lambda o: (o["cp"] <= p["cp"])
                                   & (o["at"] < p["at"]))).cast("bigint")

            def place(spot: Column, delta: Column) -> Column:
                return F.struct(
                    p["cp"].alias("n"), (spot + 1).alias("i"), (acc["h"] + 1).alias("h"),
                    _adapt(delta, acc["h"] + 1, acc["h"] == n_plain).alias("bias"),
                    F.concat(acc["out"], _varint(delta, acc["bias"])).alias("out"))

            return let(spot, lambda at: let(
                (p["cp"] - acc["n"]) * (acc["h"] + 1) + at - acc["i"], lambda d: place(at, d)))

        special = F.array_sort(F.filter(points, lambda p: p["cp"] >= INITIAL_N))
        return F.aggregate(special, start, insert, lambda acc: acc["out"])

    return let(points, lambda ps: F.concat(
        F.lit("xn--"), insert_all(ps, F.length(basic).cast("bigint"))))


def ascii_host(host: Column) -> Column:
    """Host, mapped if it is not ASCII, with every non-ASCII label in its ``xn--`` form."""
    def encoded(h: Column) -> Column:
        return F.array_join(F.transform(
            F.split(h, r"\."),
            lambda label: F.when(label.rlike(NON_ASCII), _encode_label(label)).otherwise(label)), ".")

    return let(host, lambda h: F.when(h.rlike(NON_ASCII), let(mapped_host(h), encoded)).otherwise(h))
