"""E-mail, phone and web-address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmfold.functions.punycode import DOTS, NON_ASCII, ascii_host
from firmfold.functions.text import BLANK_CLASS, empty_to_null, js_trim, let, strip_tags

# One @, no blanks, a dot after it. Nearly all addresses are printable ASCII,
# whose character class is a plain bit set; only the others need all blanks.
EMAIL_ASCII = r"^[!-?A-~]++@[!-?A-~]+\.[!-?A-~]++\z"
EMAIL_SHAPE = rf"^[^@{BLANK_CLASS}]++@[^@{BLANK_CLASS}]+\.[^@{BLANK_CLASS}]++\z"

# What counts as an e-mail or a Hungarian phone candidate in text.
EMAIL_IN_TEXT = r"(?i)[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}"
PHONE_IN_TEXT = (rf"(?:\+?36|06)[{BLANK_CLASS}\-/().]*[0-9]"
                 rf"[0-9{BLANK_CLASS}\-/().]{{5,}}")

# Authority part of a web address, scheme optional: user info, port and a
# leading "www." are dropped, the host must hold a dot, and a character that no
# host may hold makes the whole address unusable.
_NOT_IN_HOST = r"/?#\\:@\x00-\x20\x7F<>\[\]^|%"
HOST_IN_URL = (r"^(?:https?://)?+[/\\]*+(?:[^/?#\\]*@)?+(?:www\.)?+"
               rf"([^{_NOT_IN_HOST}.]*\.[^{_NOT_IN_HOST}]*)(?::[0-9]{{0,5}})?(?:[/?#\\]|\z)")


def norm_email(c: Column) -> Column:
    e = F.lower(js_trim(c))
    return F.when(e.contains("@") & (e.rlike(EMAIL_ASCII) | e.rlike(EMAIL_SHAPE)), e)


def norm_phone_hu(c: Column) -> Column:
    """Hungarian number as +36 and 8 or 9 subscriber digits, else null."""
    s = F.regexp_replace(c, "[^0-9+]", "")

    def rest(first: int) -> Column:
        return F.substring(s, F.lit(first), F.length(s))

    # Only the +36 spelling loses plus signs further inside.
    subscriber = (F.when(s.startswith("+36"), F.replace(rest(4), F.lit("+"), F.lit("")))
                  .when(s.startswith("0036"), rest(5))
                  .when(s.startswith("06"), rest(3))
                  .when(s.startswith("36") & (F.length(s) >= 10), rest(3)))
    return F.when(F.length(subscriber).between(8, 9), F.concat(F.lit("+36"), subscriber))


def url_domain(c: Column) -> Column:
    """Host of a web address without ``www.``; null where there is no dot."""
    s = F.translate(F.lower(js_trim(c)), f"{DOTS}\t\n\r", "." * len(DOTS))

    def checked(host: Column) -> Column:
        # Mapping may bring forth what the pattern has seen to: a leading "www.", and what no host may hold.
        def plain(ascii_: Column) -> Column:
            rest = F.regexp_replace(ascii_, r"^www\.", "")
            return F.when(~ascii_.rlike(f"[{_NOT_IN_HOST}]") & rest.contains("."), rest)

        return F.when(host.rlike(NON_ASCII), let(ascii_host(host), plain)).otherwise(host)

    return let(empty_to_null(F.regexp_extract(s, HOST_IN_URL, 1)), checked)


def emails_in(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(EMAIL_IN_TEXT), F.lit(0))
    none = F.array().cast("array<string>")
    return F.when(text.contains("@"), F.array_distinct(F.transform(found, F.lower))).otherwise(none)


def phones_in(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(PHONE_IN_TEXT), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, norm_phone_hu), lambda p: p.isNotNull()))


def extract_contacts(html: Column) -> Column:
    """Ordered distinct e-mails and phones in the visible text of a page."""
    return let(strip_tags(html), lambda text: F.struct(
        emails_in(text).alias("emails"), phones_in(text).alias("phones")))
