"""Company identity: names, registration and tax numbers, the identity key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmfold.functions.text import (NOT_AFTER_WORD, NOT_BEFORE_WORD, has_text, js_trim)

# Legal forms cut from a name before names are compared. The
# groups are removed one after the other; accents are significant.
LEGAL_FORMS = [
    ["kft", "zrt", "nyrt", "bt", "kkt"],
    ["e.v."],
    ["ev", "egyéni vállalkozó", "egyeni vallalkozo", "kht", "szövetkezet", "szovetkezet"],
]

# A name holding one of these belongs to a natural person.
SOLE_TRADER_MARKERS = ["e.v.", "ev.", "egyéni vállalkozó", "egyeni vallalkozo", "őstermelő",
                       "ostermelo"]

# Mailboxes that start like this are shared, not personal.
SHARED_MAILBOXES = ["info", "iroda", "office", "kapcsolat", "contact", "hello", "sales", "ugyfel",
                    "ugyfelszolgalat", "admin", "titkarsag", "rendeles"]

# Weights of the check digit of a Hungarian tax number.
VAT_WEIGHTS = [9, 7, 3, 1, 9, 7, 3]


def _form_pattern(forms: list[str]) -> str:
    """Forms as standalone words, a word being made of ASCII characters only.

    A form that ends in another character has its right edge where such a word
    begins, hence the lookahead for one.
    """
    parts = []
    for form in forms:
        edge = NOT_BEFORE_WORD if form[-1].isascii() and form[-1].isalnum() else "(?=[A-Za-z0-9_])"
        parts.append(form.replace(".", r"\.") + edge)
    return f"{NOT_AFTER_WORD}(?:{'|'.join(parts)})"


def norm_company_name(c: Column) -> Column:
    """Lower-cased letters and digits of a name, without its legal form."""
    s = js_trim(F.lower(F.coalesce(c, F.lit(""))))
    for group in LEGAL_FORMS:
        s = F.regexp_replace(s, _form_pattern(group), " ")
    return js_trim(F.regexp_replace(s, r"[^\p{L}\p{N}]+", " "))


def digits_only(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def is_valid_reg_number(c: Column) -> Column:
    return F.length(digits_only(c)) == 10


def is_valid_hu_vat(c: Column) -> Column:
    """8 or 11 digits whose eighth is the check digit of the first seven."""
    d = digits_only(c)

    def digit(i: int) -> Column:
        return F.ascii(F.substring(d, i, 1)) - F.lit(48)

    weighted = reduce(lambda a, b: a + b,
                      [digit(i + 1) * F.lit(w) for i, w in enumerate(VAT_WEIGHTS)])
    return (F.length(d).isin(8, 11)) & ((weighted + digit(8)) % 10 == 0)


def vat_core(c: Column) -> Column:
    """The 8 digits under which a tax number is registered; null if unusable."""
    return F.when(is_valid_hu_vat(c), F.substring(digits_only(c), 1, 8))


def dedupe_key(vat: Column, reg: Column, domain: Column, name: Column, region: Column) -> Column:
    """Best available identity: tax number, company number, site, then name."""
    return F.coalesce(
        F.concat(F.lit("vat:"), vat_core(vat)),
        F.when(is_valid_reg_number(reg), F.concat(F.lit("reg:"), digits_only(reg))),
        F.when(has_text(domain), F.concat(F.lit("domain:"), F.lower(domain))),
        F.concat(F.lit("name:"), norm_company_name(name), F.lit("|"),
                 F.coalesce(region, F.lit(""))))


def looks_personal(name: Column, email: Column) -> Column:
    """Sole trader by name, or a first.last mailbox that is not a shared one."""
    low = F.lower(name)
    marked = reduce(lambda a, b: a | b, [low.contains(m) for m in SOLE_TRADER_MARKERS])
    mailbox = F.substring_index(email, "@", 1)
    named = mailbox.rlike(r"^[a-z]+[._][a-z]+\z") & ~mailbox.rlike(f"^(?:{'|'.join(SHARED_MAILBOXES)})")
    return F.coalesce(marked, F.lit(False)) | F.coalesce(named, F.lit(False))


def email_domain(email: Column) -> Column:
    """What follows the first @ of a lower-cased address."""
    parts = F.split(F.lower(js_trim(email)), "@")
    return F.get(parts, F.lit(1))


def suppression_keys(email: Column, domain: Column) -> list[Column]:
    """The values under which a record can be suppressed; null where absent."""
    return [F.nullif(F.lower(js_trim(email)), F.lit("")), email_domain(email),
            F.nullif(F.lower(js_trim(domain)), F.lit(""))]
