"""License scans: fuzzy search for short notices by pigeonhole seeds and bounded-error matching.

Texts are normalised to their words (A-Z as a-z) joined by blanks. A notice of n
characters may differ by k = n // ``EDIT_EVERY`` edits, whatever its length. Cut into k + 1 pieces, at least
one piece of any such match is unchanged, so one Aho-Corasick pass over all pieces of
all notices locates every candidate. Around each, the regex library matches the notice
with bounded errors (``{e<=k}``) from every word start, up to a word end, and its
match gives span and edits. The bound starts at a lower bound of the edits, counted
in one bit-parallel pass (Myers) over the stretch, and rises until there is a match:
stretches without any are left at once, and the first match is the best. Places of one
notice do not overlap: the best goes first, then the best in what it leaves free, before
and after it, until none is left. Of equally good places the first one counts, and its
end is the one that the library finds.

The base, exact phrases at word places, is counted separately, and its labels stay.

Defined results: a null or empty text has no words, no label, null places and score 0;
the score is 1 with a base place, else the best match's share of unchanged characters;
rows are scanned one by one, so repeated and null ids are kept as they are; an empty
table gives an empty result. Whole texts are scanned; only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect, insort
from heapq import heapify, heappop, heappush
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.llm.common import pick

EDIT_EVERY = 8

# The base's phrases, and notices as they stand in public licences.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    "all rights reserved": "reserved",
    "licensed under the apache license version 2 0": "apache",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "licensed under cc by nc": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "creative commons attribution sharealike": "cc-by-sa",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "mozilla public license version 2 0": "mpl",
    "this is free and unencumbered software released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
}
# What the rate gives the longest notice; no bound of its own.
EDITS_MOST = max(map(len, NOTICES)) // EDIT_EVERY

_SCHEMA = ("id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
           "labels string, score double, spans array<struct<label: string, notice: string, first_word: bigint, "
           "n_words: int, edits: int>>")


def _edits(masks: dict[str, int], n: int, text: str) -> list[int]:
    """For each end in the text, the edits between a notice of n characters and the best stretch that ends there."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    more, less, edits, out = full, 0, n, []
    for c in text:
        same = masks.get(c, 0)
        across = (((same & more) + more) ^ more) | same
        up, down = less | ~(across | more) & full, more & across
        edits += 1 if up & top else -1 if down & top else 0
        up, down, held = (up << 1) & full, (down << 1) & full, same | less
        more, less = down | ~(held | up) & full, up & held
        out.append(edits)
    return out


def _free(held: list[tuple[int, int]], low: int, high: int) -> Iterator[tuple[int, int]]:
    """The parts of a stretch of words outside the places held."""
    k = max(0, bisect(held, (low, low)) - 1)
    while k < len(held) and held[k][0] < high:
        start, end = held[k]
        if end > low:
            if low < start - 1:
                yield low, start - 1
            low = end + 1
        k += 1
    if low < high:
        yield low, high


class Scanner:
    """Compiled notices; one per task."""

    def __init__(self, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, edit_every: int = EDIT_EVERY) -> None:
        import ahocorasick
        import regex

        self._base, self._notices = base, notices
        # Upper case to lower case; other ASCII characters that are not of a word to blanks.
        self._map = bytes((b + 32 if 65 <= b <= 90 else b if b >= 0x80 or chr(b).isalnum() else 32) for b in range(256))
        self._patterns, seeds = {}, {}
        for notice in notices:
            edits = len(notice) // edit_every
            masks: dict[str, int] = {}
            for k, c in enumerate(notice):
                masks[c] = masks.get(c, 0) | 1 << k
            self._patterns[notice] = masks, [
                regex.compile(f"(?:{regex.escape(notice)}){{e<={k}}}(?![^ ])") for k in range(edits + 1)]
            cuts = [len(notice) * k // (edits + 1) for k in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                seeds.setdefault(notice[a:b], []).append((notice, b))
        self._seeds = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self._seeds.add_word(seed, places)
        self._seeds.make_automaton()

    def words(self, text: str | None) -> list[bytes]:
        return (text or "").encode("utf-8", "surrogatepass").translate(self._map).split(b" ")

    def _windows(self, flat: str) -> dict[str, set[tuple[int, int]]]:
        """Of each notice the stretches of whole words that a match around a seed lies in."""
        windows: dict[str, set[tuple[int, int]]] = {}
        for last, places in self._seeds.iter(flat):
            for notice, end in places:
                edits = len(self._patterns[notice][1]) - 1
                start = last + 1 - end
                low, high = max(0, start - edits), min(len(flat), start + len(notice) + edits)
                while low < high and low and flat[low - 1] != " ":
                    low += 1
                while low < high < len(flat) and flat[high] != " ":
                    high -= 1
                windows.setdefault(notice, set()).add((low, high))
        return windows

    def _best(self, notice: str, flat: str, low: int, high: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best match within a stretch of words, the first of equal ones."""
        masks, bounded = self._patterns[notice]
        n, edits = len(notice), len(bounded) - 1
        if high - low < max(1, n - edits):
            return None
        by_end = enumerate(_edits(masks, n, flat[low:high]), low + 1)
        least = min((e for end, e in by_end if end == high or flat[end] == " "), default=n)
        if least > edits:
            return None
        starts = [at for at in range(low, high - n + edits + 1) if at == low or flat[at - 1] == " "]
        for pattern in bounded[least:]:
            for start in starts:
                if match := pattern.match(flat, start, high):
                    return sum(match.fuzzy_counts), start, match.end()
        return None

    def _fuzzy(self, flat: str) -> Iterator[tuple[str, int, int, int]]:
        """(notice, start, end, edits) of every match; of overlapping ones of a notice the best."""
        for notice, windows in self._windows(flat).items():
            heap = [(*found, *w) for w in windows if (found := self._best(notice, flat, *w))]
            heapify(heap)
            held: list[tuple[int, int]] = []
            while heap:
                edits, start, end, low, high = heappop(heap)
                k = bisect(held, (start, end))
                if not (k and held[k - 1][1] > start or k < len(held) and held[k][0] < end):
                    insort(held, (start, end))
                    yield notice, start, end, edits
                for part in _free(held, low, high):
                    if found := self._best(notice, flat, *part):
                        heappush(heap, (*found, *part))

    def scan(self, text: str | None) -> tuple:
        found = [w for w in self.words(text) if w]
        flat = b" ".join(found).decode("utf-8", "surrogatepass")
        padded = f" {flat} "
        places, base_labels = [], set()
        blanks = np.flatnonzero(np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype="<u4") == 32)
        before = lambda at: int(np.searchsorted(blanks, at))  # noqa: E731  blanks of the padded text in front of a place
        for phrase, label in self._base.items():
            at = padded.find(f" {phrase} ")
            while at >= 0:
                places.append(before(at))
                base_labels.add(label)
                at = padded.find(f" {phrase} ", at + 1)
        spans, best = [], 1.0 if places else 0.0
        taken: dict[int, list[tuple[int, int, int]]] = {}  # by stretches of 128 characters
        for notice, start, end, edits in sorted(self._fuzzy(flat), key=lambda m: m[3]):
            # Of notices that differ little, the one that fits a place best has it; a longer one stays beside a shorter.
            cells = range(start // 128, end // 128 + 1)
            if any(a < end and start < b and e < edits and b - a + edits >= end - start for c in cells for a, b, e in taken.get(c, ())):
                continue
            for c in cells:
                taken.setdefault(c, []).append((start, end, edits))
            spans.append((self._notices[notice], notice, before(start + 1) - 1, before(end + 1) - before(start + 1) + 1, edits))
            best = max(best, 1 - edits / len(notice))
        labels = base_labels | {s[0] for s in spans}
        return (len(found), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(labels)), best, sorted(spans, key=lambda s: (s[2], s[1])))


def scan(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, edit_every: int = EDIT_EVERY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, word counts and places of the base, labels, score, and spans in words."""
    names = [part.split(":")[0].split()[0] for part in _SCHEMA.split(", spans")[0].split(", ")] + ["spans"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(base, notices, edit_every)
        keys = ("label", "notice", "first_word", "n_words", "edits")
        for batch in batches:
            rows = []
            for doc, text in zip(batch["id"], batch["text"]):
                *plain, spans = scanner.scan(text)
                rows.append((doc, *plain, [dict(zip(keys, s)) for s in spans]))
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"id": "Int64", "first_word": "Int64", "last_word": "Int64"})

    return pick(docs, id=id_col, text=text_col).mapInPandas(run, _SCHEMA).withColumnRenamed("id", id_col)
