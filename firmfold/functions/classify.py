"""Classification by keywords and code prefixes, and region detection."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmfold.functions.rules import (DEFAULT_RULES, PrefixRule, RuleSet, folded_keywords,
                                      word_pattern)
from firmfold.functions.text import fold_text, let

# First group of exactly four digits, as a word of its own.
POSTCODE = r"(?<![A-Za-z0-9_])([0-9]{4})(?![A-Za-z0-9_])"


# Up to here a plain substring search per keyword beats one expression for all.
PLAIN_SEARCHES = 24


def mentions(hay: Column, stems=(), words=()) -> Column:
    """Does folded text hold a stem anywhere, or a word on its own?

    The costly whole-word match runs only where one of the words occurs at all.
    """
    stems, words = folded_keywords(stems), folded_keywords(words)

    def holds(keywords: list[str]) -> Column:
        if len(keywords) > PLAIN_SEARCHES:
            return hay.rlike("|".join(re.escape(k) for k in keywords))
        return reduce(lambda a, b: a | b, [hay.contains(k) for k in keywords])

    out = holds(stems) if stems else F.lit(False)
    return out | (holds(words) & hay.rlike(word_pattern(words))) if words else out


def _present(candidates: list[Column]) -> Column:
    """The non-null ones, in order (no higher-order function involved)."""
    if not candidates:
        return F.array().cast("array<string>")
    return F.array_except(F.array(*candidates), F.array(F.lit(None).cast("string")))


def classify_text(c: Column, rules: RuleSet = DEFAULT_RULES, folded: bool = False) -> Column:
    """Ids of all categories whose keywords occur in the text, in rule order.

    ``folded``: the column holds folded text already. Project that first where
    the whole classification is to stay inside generated code.
    """
    def ids(hay: Column) -> Column:
        return _present([F.when(mentions(hay, cat.stems, cat.words), F.lit(cat.id))
                         for cat in rules.categories if cat.stems or cat.words])

    return ids(F.coalesce(c, F.lit(""))) if folded else let(F.coalesce(fold_text(c), F.lit("")), ids)


def classify_by_prefix(codes: Column, digits: int, prefix_rules: tuple[PrefixRule, ...],
                       known: tuple[str, ...]) -> Column:
    """Categories of a list of codes: code order first, then rule order."""
    usable = [r for r in prefix_rules if r.category in known]

    def of_code(code: Column) -> Column:
        number = F.substring(F.regexp_replace(code, "[^0-9]", ""), 1, digits)
        return _present([F.when(number.startswith(r.prefix), F.lit(r.category)) for r in usable])

    if not usable:
        return F.array().cast("array<string>")
    every = F.flatten(F.transform(F.filter(codes, lambda x: x.isNotNull()), of_code))
    return F.coalesce(F.array_distinct(every), F.array().cast("array<string>"))


def cpv_to_categories(codes: Column, rules: RuleSet = DEFAULT_RULES) -> Column:
    """Procurement codes: the 8 digits before the check digit count."""
    return classify_by_prefix(codes, 8, rules.award_codes, rules.category_ids)


def activity_to_categories(codes: Column, rules: RuleSet = DEFAULT_RULES) -> Column:
    """Activity codes: 4 digits, written with or without dots."""
    return classify_by_prefix(codes, 4, rules.activity_codes, rules.category_ids)


def detect_region(address: Column, rules: RuleSet = DEFAULT_RULES, match: str = "substring",
                  folded: bool = False) -> Column:
    """Region of an address: 1xxx postcode, capital by name, then rule order.

    ``match='word'`` takes only whole words, so that a town whose name holds
    another county's keyword keeps its own county.
    """
    def region(hay: Column) -> Column:
        out = F.when(F.regexp_extract(hay, POSTCODE, 1).startswith("1"), F.lit(rules.capital))
        for r in sorted(rules.regions, key=lambda r: r.id != rules.capital):
            named = mentions(hay, r.keywords) if match == "substring" else mentions(hay, words=r.keywords)
            out = out.when(named, F.lit(r.id))
        return out

    return region(address) if folded else let(fold_text(address), region)
