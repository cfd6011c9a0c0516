"""SQL counterparts: the semantics stated again, for an ordinary SQL engine.

Plain SQL text put together from small pieces. Nothing here is used by the jobs.
The regular expressions avoid look-around, so a whole word is written with the
characters next to it.
"""

from __future__ import annotations

from firmfold.functions.identity import LEGAL_FORMS, SHARED_MAILBOXES, SOLE_TRADER_MARKERS
from firmfold.functions.rules import DEFAULT_RULES
from firmfold.functions.text import fold_str
from firmfold.suite.staging import (CRAWL_PAGES_SQL, CURSORS_SQL, SUPPRESSION_SQL, lookups_sql,
                                    raw_business_sql)

NOW = "TIMESTAMP '1999-06-01 12:00:00'"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# -- scalar pieces ---------------------------------------------------------------

def email(x: str) -> str:
    e = f"lower(trim({x}))"
    return rf"(CASE WHEN regexp_matches({e}, '^[^@\s]+@[^@\s]+\.[^@\s]+$') THEN {e} END)"


def digits(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g')"


def phone(x: str) -> str:
    s = f"regexp_replace({x}, '[^0-9+]', '', 'g')"
    sub = (f"(CASE WHEN starts_with({s}, '+36') THEN replace(substr({s}, 4), '+', '') "
           f"WHEN starts_with({s}, '0036') THEN substr({s}, 5) "
           f"WHEN starts_with({s}, '06') THEN substr({s}, 3) "
           f"WHEN starts_with({s}, '36') AND length({s}) >= 10 THEN substr({s}, 3) END)")
    return f"(CASE WHEN length({sub}) BETWEEN 8 AND 9 THEN '+36' || {sub} END)"


def domain(x: str) -> str:
    s = f"lower(trim({x}))"
    full = f"(CASE WHEN regexp_matches({s}, '^https?://') THEN {s} ELSE 'http://' || {s} END)"
    pattern = (r"^https?://[/\\]*(?:[^/?#\\]*@)?([^/?#\\:@\s<>\[\]^|%]+)(?::[0-9]{0,5})?(?:[/?#\\]|$)")
    host = rf"regexp_replace(regexp_extract({full}, '{pattern}', 1), '^www\.', '')"
    return f"(CASE WHEN contains({host}, '.') THEN {host} END)"


def vat_valid(x: str) -> str:
    d = digits(x)
    total = " + ".join(f"coalesce(try_cast(substr({d}, {i + 1}, 1) AS int), 0) * {w}"
                       for i, w in enumerate([9, 7, 3, 1, 9, 7, 3, 1]))
    return f"(length({d}) IN (8, 11) AND ({total}) % 10 = 0)"


def vat_core(x: str) -> str:
    return f"(CASE WHEN {vat_valid(x)} THEN substr({digits(x)}, 1, 8) END)"


def company_name(x: str) -> str:
    s = f"trim(lower(coalesce({x}, '')))"
    for group in LEGAL_FORMS:
        closed = [f for f in group if f[-1].isascii() and f[-1].isalnum()]
        opened = [f.replace(".", r"\.") for f in group if f not in closed]
        for _ in range(2):  # neighbours share a separator
            if closed:
                s = rf"regexp_replace({s}, '(^|[^a-z0-9_])(?:{'|'.join(closed)})($|[^a-z0-9_])', '\1 \2', 'g')"
            if opened:
                s = rf"regexp_replace({s}, '(^|[^a-z0-9_])(?:{'|'.join(opened)})([a-z0-9_])', '\1 \2', 'g')"
    return rf"trim(regexp_replace({s}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def fold(x: str) -> str:
    return f"strip_accents(lower({x}))"


def _kept(items: list[str]) -> str:
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


def _mentions(hay: str, stems, words) -> str:
    tests = [f"contains({hay}, {quoted(fold_str(s))})" for s in stems]
    if words:
        alternatives = "|".join(fold_str(w) for w in words)
        tests.append(rf"regexp_matches({hay}, '(^|[^\p{{L}}\p{{N}}])(?:{alternatives})($|[^\p{{L}}\p{{N}}])')")
    return "(" + " OR ".join(tests) + ")"


def classify(hay: str, rules=DEFAULT_RULES) -> str:
    return _kept([f"CASE WHEN {_mentions(hay, c.stems, c.words)} THEN {quoted(c.id)} END"
                  for c in rules.categories])


def by_prefix(code: str, length: int, prefix_rules) -> str:
    d = f"substr({digits(code)}, 1, {length})"
    hits = _kept([f"CASE WHEN starts_with({d}, {quoted(r.prefix)}) THEN {quoted(r.category)} END"
                  for r in prefix_rules])
    return f"list_distinct({hits})"


def region(x: str, rules=DEFAULT_RULES) -> str:
    hay = fold(x)
    zip_ = f"regexp_extract({hay}, '(?:^|[^a-zA-Z0-9_])([0-9]{{4}})(?:$|[^a-zA-Z0-9_])', 1)"
    whens = [f"WHEN starts_with({zip_}, '1') THEN 'budapest'"]
    whens += [f"WHEN {_mentions(hay, r.keywords, ())} THEN {quoted(r.id)}" for r in rules.regions]
    return f"(CASE {' '.join(whens)} END)"


def personal(name: str, mail: str) -> str:
    marks = " OR ".join(f"contains(lower({name}), {quoted(m)})" for m in SOLE_TRADER_MARKERS)
    box = f"split_part({mail}, '@', 1)"
    named = (rf"regexp_matches({box}, '^[a-z]+[._][a-z]+$') AND NOT "
             rf"regexp_matches({box}, '^(?:{'|'.join(SHARED_MAILBOXES)})')")
    return f"(coalesce({marks}, false) OR coalesce({named}, false))"


def has(x: str) -> str:
    return f"coalesce({x}, '') <> ''"


def score(p: str = "") -> str:
    return f"""cast(least(100,
      CASE WHEN {has(p + 'email')} THEN 30 ELSE 0 END + CASE WHEN {has(p + 'phone')} THEN 10 ELSE 0 END
      + CASE WHEN {has(p + 'website')} OR {has(p + 'domain')} THEN 10 ELSE 0 END
      + CASE WHEN {has(p + 'address')} THEN 10 ELSE 0 END + CASE WHEN {has(p + 'region_id')} THEN 10 ELSE 0 END
      + CASE WHEN len({p}categories) > 0 THEN 15 ELSE 0 END
      + CASE WHEN {vat_valid(p + 'vat_number')} THEN 15
             WHEN length({digits(p + 'registration_number')}) = 10 THEN 10 ELSE 0 END) AS int)"""


def joined(x: str) -> str:
    return f"array_to_string(list_sort({x}), ',')"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%gZ')"


# -- common tables ------------------------------------------------------------------

GAPS = ["brand_name", "email", "phone", "website", "domain", "address", "vat_number",
        "registration_number", "region_id"]

_PARSED_TEXT = "trim(concat(coalesce(activity, ''), ' ', trim(legal_name)))"

NORM = f"""
SELECT source, source_ord, region_ord, crawl_region, page, pos, k, e, seqno, source_url, source_license,
  trim(legal_name) AS legal_name, nullif(trim(brand_name), '') AS brand_name,
  {email('email')} AS email, {phone('phone')} AS phone, nullif(trim(website), '') AS website,
  {domain('website')} AS domain, nullif(trim(address), '') AS address,
  nullif(trim(vat_number), '') AS vat_number, nullif(trim(registration_number), '') AS registration_number,
  {region('address')} AS detected_region,
  list_distinct(list_concat({classify(fold("concat_ws(' ', nullif(" + _PARSED_TEXT + ", ''), nullif(legal_name, ''), nullif(brand_name, ''))"))},
                            {by_prefix('activity_code', 4, DEFAULT_RULES.activity_codes)})) AS categories,
  concat_ws(' ', nullif({_PARSED_TEXT}, ''), nullif(legal_name, ''), nullif(brand_name, '')) AS classification_text,
  coalesce(is_personal_data, false) OR {personal('legal_name', email('email'))} AS is_personal_data
FROM raw
"""

KEYED = f"""
SELECT n.*, coalesce(detected_region, crawl_region) AS region_id,
  CASE WHEN {vat_valid('vat_number')} THEN 'vat:' || substr({digits('vat_number')}, 1, 8)
       WHEN length({digits('registration_number')}) = 10 THEN 'reg:' || {digits('registration_number')}
       WHEN {has('domain')} THEN 'domain:' || lower(domain)
       ELSE 'name:' || {company_name('legal_name')} || '|' || coalesce(detected_region, crawl_region, '') END AS dedupe_key
FROM norm n
"""

FLAGGED = """
SELECT r.*, coalesce(email IN (SELECT value FROM sup), false)
         OR coalesce(split_part(email, '@', 2) IN (SELECT value FROM sup), false)
         OR coalesce(domain IN (SELECT value FROM sup), false) AS suppressed
FROM keyed r
"""


def merged(source: str) -> str:
    gaps = ",\n  ".join(f"arg_min({g}, seqno) FILTER (WHERE {g} IS NOT NULL) AS {g}" for g in GAPS)
    return f"""
SELECT dedupe_key, arg_min(legal_name, seqno) AS legal_name, arg_min(source, seqno) AS source,
  arg_min(source_url, seqno) AS source_url, arg_min(source_license, seqno) AS source_license,
  {gaps},
  arg_max(classification_text, (length(classification_text), -seqno)) AS classification_text,
  list_distinct(flatten(list(categories))) AS categories,
  bool_or(is_personal_data) AS is_personal_data, count(*) AS input_count, min(seqno) AS first_seq
FROM {source} GROUP BY dedupe_key
"""


LEAD = f"""
SELECT sha256(m.dedupe_key) AS lead_id, m.*, {score('m.')} AS quality_score,
  CASE WHEN k % 4 = 1 THEN 'CONTACTED' ELSE 'NEW' END AS lifecycle,
  CASE quality WHEN 1 THEN 'APPROVED' WHEN 0 THEN 'REJECTED' ELSE 'PENDING' END AS review_status,
  o_orderdate AS collected_at,
  CASE WHEN k % 13 = 0 THEN o_orderdate END AS last_verified_at,
  CASE WHEN k % 17 = 0 THEN o_orderdate END AS nav_checked_at,
  CASE WHEN k % 19 = 0 THEN o_orderdate END AS contact_checked_at,
  CASE WHEN k % 23 = 0 THEN o_orderdate END AS places_checked_at,
  CASE WHEN k % 17 = 0 THEN CASE WHEN k % 2 = 0 THEN 'ACTIVE' ELSE 'CANCELLED' END END AS tax_status,
  CASE WHEN k % 17 = 0 THEN k % 3 = 0 END AS debt_free
FROM (SELECT *, ((first_seq // 100) % 10000000 - 1) * 40 + first_seq % 100 AS k FROM merged) m
LEFT JOIN orders ON o_orderkey = k LEFT JOIN labels ON doc_id = k
"""

# Answers as the parsers read them, from what the texts were made of.
LOOKUP_TABLES = {
    "vat_register": """SELECT core, e % 3 = 1 AS valid,
        CASE WHEN e % 4 <> 0 THEN concat('Fő utca ', e) END AS address FROM lk""",
    "tax_signals": """SELECT core, CASE e % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'SUSPENDED'
        WHEN 2 THEN 'CANCELLED' ELSE 'UNKNOWN' END AS tax_status,
        CASE e % 3 WHEN 0 THEN true WHEN 1 THEN false END AS debt_free,
        CASE e % 6 WHEN 0 THEN 12 WHEN 1 THEN 7 WHEN 2 THEN 0 END AS employee_count FROM lk""",
    # The home page has no address, the contact page has two and ends the search.
    "contacts": """SELECT domain, concat('hello@ceg', e, '.hu') AS email,
        '+3670' || lpad(cast(e % 10000000 AS varchar), 7, '0') AS phone FROM lk""",
    "places": """SELECT place_name AS name, concat('+36 1 555 ', e % 10000) AS phone,
        concat('https://hely', e, '.hu/x') AS website, concat('hely', e, '.hu') AS domain,
        CASE WHEN e % 3 <> 0 THEN 'Hely tér 1' END AS address FROM lk""",
}


def _ctes() -> dict[str, str]:
    out = {
        "raw": raw_business_sql(), "norm": NORM, "keyed": KEYED,
        "sup": SUPPRESSION_SQL.format(supplier="supplier"), "flagged": FLAGGED,
        "merged": merged("keyed"), "lead": LEAD, "lk": lookups_sql(),
        "pg": CRAWL_PAGES_SQL.format(orders="orders"),
        "cur": CURSORS_SQL.format(pages=CRAWL_PAGES_SQL.format(orders="orders")),
    }
    return out | LOOKUP_TABLES


_NEEDS = {"norm": ["raw"], "keyed": ["norm"], "flagged": ["keyed", "sup"], "merged": ["keyed"],
          "lead": ["merged"], "vat_register": ["lk"], "tax_signals": ["lk"], "contacts": ["lk"],
          "places": ["lk"]}


def sql(select: str, *names: str, raw: str | None = None, **extra: str) -> str:
    """``select`` under the common tables it names and what those need.

    ``raw`` puts other text in the place of the staged records.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    known = _ctes() | ({"raw": raw} if raw else {})
    parts = [f"{n} AS ({known[n]})" for n in ordered] + [f"{n} AS ({t})" for n, t in extra.items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + select
