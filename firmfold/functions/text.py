"""Text expressions: trimming, folding, entity decoding, tag removal."""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode blank counts as white space, not just the ASCII ones, so the
# engine's own trim() and \s are too narrow.
_BLANK_POINTS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B),
                 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
BLANKS = "".join(map(chr, _BLANK_POINTS))
# The same set for use inside [...]; Java's \s covers the ASCII ones.
BLANK_CLASS = r"\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"

# ASCII word boundaries (Java's \b also looks at letters outside ASCII).
NOT_AFTER_WORD = r"(?<![A-Za-z0-9_])"
NOT_BEFORE_WORD = r"(?![A-Za-z0-9_])"


def js_trim(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    """Trimmed text, or null where nothing is left."""
    return F.nullif(js_trim(c), F.lit(""))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# Blanks that are not a single space already: in running text, few.
_BLANK_RUN = f"[{BLANK_CLASS}&&[^ ]][{BLANK_CLASS}]*| [{BLANK_CLASS}]+"


def collapse_blanks(c: Column) -> Column:
    return js_trim(F.regexp_replace(c, _BLANK_RUN, " "))


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often it is used.

    For deep expressions with repeated operands, where common subexpressions
    are not found (inside lambdas and conditional branches).
    """
    return F.get(F.transform(F.array(c), body), F.lit(0))


def never_shared(key: Column, row: Column) -> Column:
    """The key; where it is null or empty, a text of the row's own that no key can be.

    Rows without a key would otherwise meet in one join task.
    """
    return F.coalesce(F.nullif(key, F.lit("")), F.concat(F.lit("\x01"), row.cast("string")))


def has_text(c: Column) -> Column:
    """True where the value is neither null nor empty."""
    return F.coalesce(c, F.lit("")) != ""


@lru_cache(maxsize=1)
def _fold_pairs() -> tuple[str, str]:
    """Lower-case characters whose canonical decomposition is one base plus marks."""
    src, dst = [], []
    for cp in range(0x80, 0x10000):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF or 0x300 <= cp <= 0x36F or ch.lower() != ch:
            continue
        base = "".join(x for x in unicodedata.normalize("NFD", ch)
                       if not 0x300 <= ord(x) <= 0x36F)
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def fold_str(text: str) -> str:
    """The same folding for driver-side rule keywords."""
    decomposed = unicodedata.normalize("NFD", text.lower())
    return "".join(x for x in decomposed if not 0x300 <= ord(x) <= 0x36F)


def fold_text(c: Column) -> Column:
    """Lower case without accents. ASCII-only text skips the translation."""
    src, dst = _fold_pairs()

    def fold(low: Column) -> Column:
        bare = F.regexp_replace(F.translate(low, src, dst), r"[\u0300-\u036f]+", "")
        return F.when(low.rlike(r"[^\x00-\x7F]"), bare).otherwise(low)

    return fold(F.lower(c))


def _char_of(code_point: Column, original: Column) -> Column:
    """Text of a code point; the original token where there is none."""
    as_hex = F.lpad(F.hex(code_point), 8, "0")
    is_char = code_point.between(0, 0x10FFFF) & ~code_point.between(0xD800, 0xDFFF)
    return (F.when(code_point == 0xFEFF, F.lit("\ufeff"))
            .when(is_char, F.decode(F.unhex(as_hex), "UTF-32"))
            .otherwise(original))


def _replace_tokens(c: Column, pattern: str, to_text) -> Column:
    tokens = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))

    def put_together(pieces: Column) -> Column:
        tails = F.slice(pieces, F.lit(2), F.size(pieces) - 1)
        joined = F.zip_with(F.transform(tokens, to_text), tails, lambda t, p: F.concat(t, p))
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(joined, ""))

    return let(F.split(c, pattern, -1), put_together)


def decode_entities(c: Column) -> Column:
    """Hex, then decimal, then the named entities, each in a single pass."""

    def from_hex(token: Column) -> Column:
        digits = F.regexp_replace(token, r"(?i)^&#x0*|;$", "")
        value = F.when(F.length(digits) <= 6,
                       F.conv(F.concat(F.lit("0"), digits), 16, 10).try_cast("bigint"))
        return F.coalesce(_char_of(value, token), token)

    def from_dec(token: Column) -> Column:
        value = F.regexp_replace(token, "[^0-9]", "").try_cast("bigint")
        return F.coalesce(_char_of(value, token), token)

    def numeric(text: Column) -> Column:
        hexed = _replace_tokens(text, r"(?i)&#x[0-9a-f]+;", from_hex)
        both = let(hexed, lambda t: _replace_tokens(t, r"&#[0-9]+;", from_dec))
        return F.when(text.contains("&#"), both).otherwise(text)

    def named(text: Column) -> Column:
        # The ampersand comes last so that what it uncovers is not decoded again.
        for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
                             ("&nbsp;", " "), ("&amp;", "&")):
            text = F.replace(text, F.lit(entity), F.lit(char))
        return text

    return let(c, lambda t: F.when(t.contains("&"), named(numeric(t))).otherwise(t))


def strip_tags(c: Column) -> Column:
    """Visible text: tags become blanks; script and style text is kept."""
    bare = F.when(c.contains("<"), F.regexp_replace(c, "<[^>]*>", " ")).otherwise(c)
    return collapse_blanks(decode_entities(bare))


def iso_timestamp(c: Column) -> Column:
    """UTC ISO-8601 with milliseconds (the session time zone is UTC)."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
