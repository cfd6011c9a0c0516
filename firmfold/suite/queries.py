"""One registered query per operator, with its SQL counterpart.

Every query runs over whole tables. ``QUERIES[name](spark, sf_dir)`` gives the
frame, ``ORACLES[name]`` the SQL text; a query without text is checked by tests.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmfold.functions import classify as C
from firmfold.functions import contact as K
from firmfold.functions import identity as I
from firmfold.functions import score as Q
from firmfold.functions.rules import DEFAULT_RULES, Category, PrefixRule, RuleSet
from firmfold.functions.text import decode_entities, fold_text, iso_timestamp, strip_tags
from firmfold.operators import consolidate as M
from firmfold.operators import enrich as E
from firmfold.operators import export as X
from firmfold.operators import govern as G
from firmfold.operators import pages as P
from firmfold.operators import report as R
from firmfold.operators import review as V
from firmfold.operators import suppress as U
from firmfold.operators.audit import audit_rollup as rollup
from firmfold.operators.audit import ingest_events
from firmfold.operators.rule_tables import RuleTables, classify_by_rules, codes_by_rules, regions_by_rules
from firmfold.plans import jobs as J
from firmfold.plans.ingest import ingest as ingest_job
from firmfold.plans.store import Store
from firmfold.session import configure, scratch_dir
from firmfold.sources.pages import explode_records, parse_pages, read_pages, row_counts
from firmfold.sources.registry import get_source
from firmfold.suite import frames as W
from firmfold.suite import oracle as O
from firmfold.suite import staging as S
from firmfold.streaming.ingest_stream import audit_stream as stream_counts
from firmfold.streaming.ingest_stream import ingest_stream as run_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(configure(spark), sf)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def joined(c: str | Column) -> Column:
    return F.array_join(F.array_sort(c), ",")


def stamp(c: str) -> Column:
    return iso_timestamp(F.col(c)).alias(c)


# -- expressions over staged records ---------------------------------------------

@query(O.sql(f"SELECT source, k, {O.email('email')} AS email, {O.phone('phone')} AS phone, "
             f"{O.domain('website')} AS domain FROM raw", "raw"))
def norm_contacts(spark, sf):
    return S.raw_business(spark, sf).select(
        "source", "k", K.norm_email(F.col("email")).alias("email"),
        K.norm_phone_hu(F.col("phone")).alias("phone"), K.url_domain(F.col("website")).alias("domain"))


@query(O.sql(f"""SELECT source, k, {O.vat_valid('vat_number')} AS is_valid, {O.vat_core('vat_number')} AS core,
  length({O.digits('registration_number')}) = 10 AS reg_valid FROM raw""", "raw"))
def vat_checksum(spark, sf):
    v = F.col("vat_number")
    return S.raw_business(spark, sf).select(
        "source", "k", I.is_valid_hu_vat(v).alias("is_valid"), I.vat_core(v).alias("core"),
        I.is_valid_reg_number(F.col("registration_number")).alias("reg_valid"))


@query(O.sql(f"SELECT source, k, {O.company_name('legal_name')} AS name_key, dedupe_key FROM keyed", "keyed"))
def company_name_key(spark, sf):
    return W.batch(spark, sf).select(
        "source", "k", I.norm_company_name(F.col("legal_name")).alias("name_key"), "dedupe_key")


_NORM_COLUMNS = ["legal_name", "brand_name", "email", "phone", "website", "domain", "address", "vat_number",
                 "registration_number", "classification_text", "source_url", "source_license",
                 "is_personal_data"]


@query(O.sql(f"SELECT source, k, {', '.join(_NORM_COLUMNS)}, detected_region AS region_id, "
             f"{O.joined('categories')} AS categories FROM norm", "norm"))
def normalize_businesses(spark, sf):
    return W.normalised(spark, sf).select("source", "k", *_NORM_COLUMNS, "region_id",
                                          joined("categories").alias("categories"))


@query(O.sql("SELECT source, k, detected_region, region_id FROM keyed", "keyed"))
def detect_region(spark, sf):
    return W.batch(spark, sf).select(
        "source", "k", C.detect_region(F.col("address")).alias("detected_region"), "region_id")


@query(O.sql("SELECT region_id, count(*) AS n FROM keyed GROUP BY region_id", "keyed"))
def region_fallback(spark, sf):
    return W.batch(spark, sf).groupBy("region_id").agg(F.count(F.lit(1)).alias("n"))


@query(O.sql(f"SELECT source, k, {O.personal('legal_name', O.email('email'))} AS is_personal FROM raw", "raw"))
def personal_flag(spark, sf):
    return S.raw_business(spark, sf).select(
        "source", "k", I.looks_personal(F.col("legal_name"), K.norm_email(F.col("email"))).alias("is_personal"))


@query(O.sql(f"SELECT source, k, {O.joined(O.by_prefix('activity_code', 4, DEFAULT_RULES.activity_codes))} "
             "AS categories FROM raw", "raw"))
def activity_to_categories(spark, sf):
    return S.raw_business(spark, sf).select(
        "source", "k", joined(C.activity_to_categories(F.array("activity_code"))).alias("categories"))


# Codes of parts: four digits of the size and a letter-laden check part.
_PART_CODE = "concat(lpad(cast(p_size * 20 AS varchar(20)), 4, '0'), '.', cast(p_partkey % 100 AS varchar(20)), '-', p_brand)"
_PART_RULES = (PrefixRule("0", "small"), PrefixRule("02", "mid"), PrefixRule("06", "mid"), PrefixRule("1", "large"),
               PrefixRule("10", "large"), PrefixRule("08", "unlisted"))


@query(f"""SELECT p_partkey, {O.joined(O.by_prefix(_PART_CODE, 8, [r for r in _PART_RULES if r.category != 'unlisted']))}
 AS categories FROM part""")
def classify_codes(spark, sf):
    code = F.expr(_PART_CODE)
    return S.table(spark, sf, "part").select("p_partkey", joined(F.array_distinct(C.classify_by_prefix(
        F.array(code), 8, _PART_RULES, ("small", "mid", "large")))).alias("categories"))

# -- rule tables of any size --------------------------------------------------------

# Rules made of line items: whole words, stems, words of two parts; accents fold away.
_RULES_SQL = """SELECT concat('cat', cast(l_partkey % 300 AS varchar(20))) AS category, 'name' AS name,
  l_orderkey * 10 + l_linenumber AS ord, l_linenumber % 3 = 0 OR l_linenumber % 3 = 2 AS whole_word,
  CASE l_linenumber % 3 WHEN 0 THEN concat(' K', cast(l_partkey % 700 AS varchar(20)))
    WHEN 1 THEN concat(CASE WHEN l_suppkey % 9 = 0 THEN 'é' ELSE '' END,
                       substr(md5(cast(l_orderkey AS varchar(20))), 1, 4 + cast(l_linenumber % 2 AS int)))
    ELSE concat('Building ', cast(l_suppkey % 40 AS varchar(20))) END AS keyword
FROM {lineitem}"""
_RULE_TEXTS_SQL = """SELECT c_custkey AS k, CASE WHEN c_custkey % 50 <> 7 THEN
  concat('Ügyfél k', cast(c_custkey % 900 AS varchar(20)), ' É', md5(cast(c_custkey AS varchar(20))), ' ', c_mktsegment, ' ',
         cast(c_nationkey AS varchar(20)), ' k', cast(c_custkey % 70 AS varchar(20)), 'x') END AS text FROM {customer}"""


def _tables_sql(spark, text, sf, *names):
    return spark.sql(text.format(**{n: S.at(sf, n) for n in names}))


def _rule_tables(spark, sf):
    categories = _tables_sql(spark, _RULES_SQL, sf, "lineitem")
    regions = _tables_sql(spark, _REGION_RULES_SQL, sf, "orders")
    return RuleTables(categories, regions, None, capital="r5")


@query(f"""WITH rule AS (SELECT category, trim(strip_accents(lower(keyword))) AS kw, whole_word, ord FROM ({_RULES_SQL.format(lineitem="lineitem")})),
place AS (SELECT category, min(ord) AS place FROM rule GROUP BY category),
txt AS (SELECT k, strip_accents(lower(coalesce(text, ''))) AS hay FROM ({_RULE_TEXTS_SQL.format(customer="customer")})),
kws AS (SELECT DISTINCT kw, whole_word, category FROM rule),
hit AS (SELECT DISTINCT k, category FROM txt JOIN kws ON CASE WHEN whole_word THEN contains(' ' || hay || ' ', ' ' || kw || ' ')
  ELSE contains(hay, kw) END)
SELECT t.k, coalesce(string_agg(h.category, ',' ORDER BY p.place, h.category), '') AS categories FROM txt t LEFT JOIN hit h ON h.k = t.k
  LEFT JOIN place p ON p.category = h.category GROUP BY t.k""")
def rules_from_tables(spark, sf):
    texts = _tables_sql(spark, _RULE_TEXTS_SQL, sf, "customer")
    found = classify_by_rules(texts, _rule_tables(spark, sf), fold_text(F.col("text")))
    return found.select("k", F.array_join("categories", ",").alias("categories"))


_REGION_RULES_SQL = """SELECT concat('r', cast(o_orderkey % 97 AS varchar(20))) AS region_id, 'name' AS name, o_orderkey AS ord,
  concat('Vár', cast(o_custkey % 2000 AS varchar(20)), CASE WHEN o_custkey % 3 = 0 THEN ' ut' ELSE '' END) AS keyword FROM {orders}"""
_PLACES_SQL = """SELECT c_custkey AS k, CASE WHEN c_custkey % 40 <> 3 THEN concat(
  CASE c_custkey % 7 WHEN 0 THEN '1051 ' WHEN 1 THEN '21051 ' WHEN 2 THEN '8900, 1234 ' ELSE '' END,
  'VÁR', cast(c_custkey AS varchar(20)), CASE WHEN c_custkey % 2 = 0 THEN ' út' ELSE '' END) END AS address FROM {customer}"""


@query(rf"""WITH rule AS (SELECT region_id, strip_accents(lower(keyword)) AS kw, ord FROM ({_REGION_RULES_SQL.format(orders="orders")})),
place AS (SELECT region_id, min(ord) AS place FROM rule GROUP BY region_id),
kws AS (SELECT DISTINCT kw, region_id FROM rule),
txt AS (SELECT k, strip_accents(lower(coalesce(address, ''))) AS hay FROM ({_PLACES_SQL.format(customer="customer")})),
hit AS (SELECT k, arg_min(r.region_id, (CASE WHEN r.region_id = 'r5' THEN 0 ELSE 1 END, place, r.region_id)) AS region_id
  FROM txt JOIN kws r ON contains(hay, r.kw) JOIN place p ON p.region_id = r.region_id GROUP BY k)
SELECT t.k, CASE WHEN starts_with(regexp_extract(hay, '(?:^|[^a-zA-Z0-9_])([0-9]{{4}})(?:$|[^a-zA-Z0-9_])', 1), '1') THEN 'r5'
  ELSE h.region_id END AS region_id FROM txt t LEFT JOIN hit h ON h.k = t.k""")
def regions_from_tables(spark, sf):
    places = _tables_sql(spark, _PLACES_SQL, sf, "customer")
    return regions_by_rules(places, _rule_tables(spark, sf), fold_text(F.col("address"))).select("k", "region_id")


_PREFIXES_SQL = """SELECT concat('c', cast(l_suppkey % 50 AS varchar(20))) AS category, l_orderkey * 10 + l_linenumber AS ord,
  substr(lpad(cast((l_orderkey * 7919 + l_linenumber * 15485863) % 100000000 AS varchar(20)), 8, '0'), 1,
         cast(4 + l_linenumber % 5 AS int)) AS prefix FROM {lineitem}"""
_CODES_SQL = """SELECT o_orderkey AS k, lpad(cast((o_orderkey * 7919 + 15485863) % 100000000 AS varchar(20)), 8, '0') AS one,
  CASE WHEN o_orderkey % 5 > 0 THEN concat('x', lpad(cast((o_custkey * 7919 + 2 * 15485863) % 100000000 AS varchar(20)), 8, '0'), '-7') END AS two
FROM {orders}"""


@query(f"""WITH rule AS (SELECT prefix, category, min(ord) AS ord FROM ({_PREFIXES_SQL.format(lineitem="lineitem")})
  WHERE category NOT LIKE '%7' GROUP BY 1, 2),
code AS (SELECT k, 0 AS pos, one AS number FROM ({_CODES_SQL.format(orders="orders")})
  UNION ALL SELECT k, 1, substr(regexp_replace(two, '[^0-9]', '', 'g'), 1, 8) FROM ({_CODES_SQL.format(orders="orders")}) WHERE two IS NOT NULL),
starts AS (SELECT k, pos, substr(number, 1, n) AS prefix FROM code, LATERAL (SELECT unnest(range(0, 9)) AS n)),
hit AS (SELECT k, category, min((pos, ord)) AS place FROM starts JOIN rule USING (prefix) GROUP BY 1, 2)
SELECT o_orderkey AS k, coalesce(string_agg(category, ',' ORDER BY place, category), '') AS categories
FROM orders LEFT JOIN hit ON k = o_orderkey GROUP BY 1""")
def prefixes_from_tables(spark, sf):
    prefixes = _tables_sql(spark, _PREFIXES_SQL, sf, "lineitem")
    known = prefixes.select("category").filter("category not like '%7'")
    rows = _tables_sql(spark, _CODES_SQL, sf, "orders")
    found = codes_by_rules(rows, prefixes, known, F.array("one", "two"), 8)
    return found.select("k", F.array_join("categories", ",").alias("categories"))


_CPV = ("CASE p_size % 4 WHEN 0 THEN '90919200-4' WHEN 1 THEN '72500000-0' WHEN 2 THEN '79713000-5' "
        "ELSE '03000000-1' END")


@query(f"SELECT p_partkey, {O.joined(O.by_prefix(_CPV, 8, DEFAULT_RULES.award_codes))} "
       "AS categories FROM part")
def cpv_to_categories(spark, sf):
    return S.table(spark, sf, "part").select(
        "p_partkey", joined(C.cpv_to_categories(F.array(F.expr(_CPV)))).alias("categories"))


# -- text tables ------------------------------------------------------------------------

# A rule set for the documents' invented languages: stems and whole words.
DOCUMENT_RULES = RuleSet(
    categories=(
        Category("stems", "stems", ("tionré", "aîche", "ungsch", "eauxmént"), ()),
        Category("words", "words", (), ("que", "und", "the", "de")),
        Category("both", "both", ("license", "copyright"), ("elle", "nicht", "email")),
        Category("rare", "rare", ("password", "secret"), ("it",)),
    ), regions=DEFAULT_RULES.regions)


@query(f"SELECT doc_id, {O.joined(O.classify(O.fold('text'), DOCUMENT_RULES))} AS categories FROM documents")
def classify_documents(spark, sf):
    return S.table(spark, sf, "documents").select(
        "doc_id", joined(C.classify_text(F.col("text"), DOCUMENT_RULES)).alias("categories"))


@query(f"SELECT doc_id, md5({O.fold('text')}) AS folded_md5 FROM documents")
def fold_documents(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", F.md5(fold_text(F.col("text"))).alias("folded_md5"))


@query(f"SELECT {O.domain('url')} AS host, count(*) AS n_pages FROM pages GROUP BY 1")
def page_hosts(spark, sf):
    return (S.table(spark, sf, "pages").groupBy(K.url_domain(F.col("url")).alias("host"))
            .agg(F.count(F.lit(1)).alias("n_pages")))


_SPACE = r"[\t\n\v\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _visible(x: str) -> str:
    """Named entities only: the tables hold no numeric ones (asserted in tests)."""
    s = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    for entity, text in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&nbsp;", " "),
                         ("&amp;", "&")):
        s = f"replace({s}, '{entity}', '{text}')"
    return f"trim(regexp_replace({s}, '{_SPACE}+', ' ', 'g'))"


@query(f"SELECT page_id, length({_visible('html')}) AS n_chars, md5({_visible('html')}) AS text_md5 FROM pages")
def page_text(spark, sf):
    text = strip_tags(F.col("html"))
    return S.table(spark, sf, "pages").select(
        "page_id", F.length(text).cast("bigint").alias("n_chars"), F.md5(text).alias("text_md5"))


@query("SELECT doc_id, md5(concat(chr(233), '<', replace(text, '&', '.'), '&amp;', chr(128512), '&#xD800;', text)) AS decoded_md5 "
       "FROM documents")
def decode_entities_documents(spark, sf):
    """All texts, without ampersands and with theirs escaped, between entities of each kind."""
    text = F.col("text")
    framed = F.concat(F.lit("&#xE9;&lt;"), F.replace(text, F.lit("&"), F.lit(".")), F.lit("&amp;amp;&#128512;&#xD800;"),
                      F.replace(text, F.lit("&"), F.lit("&amp;")))
    return S.table(spark, sf, "documents").select("doc_id", F.md5(decode_entities(framed)).alias("decoded_md5"))


def _contact_sql(key: str, table: str, body: str) -> str:
    text = _visible(body)
    emails = f"list_distinct(list_transform(regexp_extract_all({text}, '(?i)[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}'), lambda x: lower(x)))"
    space = _SPACE[1:-1]
    phones = (f"list_distinct(list_filter(list_transform(regexp_extract_all({text}, "
              f"'(?:\\+?36|06)[{space}\\-/().]*[0-9][0-9{space}\\-/().]{{5,}}'), "
              f"lambda x: {O.phone('x')}), lambda p: p IS NOT NULL))")
    return f"SELECT {key}, {O.joined(emails)} AS emails, {O.joined(phones)} AS phones FROM {table}"


def _contacts(rows: DataFrame, key: str, body: str) -> DataFrame:
    found = rows.select(key, K.extract_contacts(F.col(body)).alias("c"))
    return found.select(key, joined("c.emails").alias("emails"), joined("c.phones").alias("phones"))


@query(_contact_sql("doc_id", "documents", "text"))
def contacts_from_documents(spark, sf):
    return _contacts(S.table(spark, sf, "documents"), "doc_id", "text")


@query(_contact_sql("page_id", "pages", "html"))
def contacts_from_pages(spark, sf):
    return _contacts(S.table(spark, sf, "pages"), "page_id", "html")


# -- parsers over pages built from the records ----------------------------------------

def _page_rows(spark, sf, source: str, record: Column) -> DataFrame:
    """Landed JSON pages: at most one page of records is put together per group."""
    rows = S.raw_business(spark, sf).select("crawl_region", "source", "page", "pos", "k", record.alias("j"))
    body = F.concat(F.lit('{"page":1,"results":['),
                    F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "k", "j"))),
                                             lambda x: x["j"]), ","), F.lit("]}"))
    return rows.groupBy("source", "crawl_region", "page").agg(body.alias("body")).select(
        F.lit(source).alias("source"), F.concat_ws("/", "source", "crawl_region").alias("region_id"), "page", "body")


def _named() -> Column:
    """Some records have no name."""
    return F.expr("CASE WHEN k % 29 = 0 THEN '  ' ELSE legal_name END")


_POS = ("cast(row_number() OVER (PARTITION BY source, crawl_region, page ORDER BY pos, k) - 1 AS int) AS pos, "
        "concat(source, '/', crawl_region) AS region_id, page")
_TEXT = "trim(concat(coalesce({0}, ''), ' ', trim(legal_name)))"


def _parsed(spark, sf, source: str, pages: DataFrame, *columns: str) -> DataFrame:
    rows = explode_records(parse_pages(pages, get_source(source)))
    return rows.select(F.col("crawl_region").alias("region_id"), "page", "pos", "legal_name",
                       "classification_text", "source_url", *columns)


@query(O.sql(f"""SELECT {_POS}, trim(legal_name) AS legal_name, {_TEXT.format('activity')} AS classification_text,
  concat('https://directory.example/biz/', k) AS source_url, email, phone, website, address, vat_number
  FROM raw WHERE k % 29 <> 0""", "raw"))
def parse_directory_pages(spark, sf):
    pages = _directory_pages(spark, sf)
    return _parsed(spark, sf, "directory", pages, "email", "phone", "website", "address", "vat_number")


def _directory_pages(spark, sf) -> DataFrame:
    record = F.to_json(F.struct(F.col("k").alias("id"), _named().alias("name"), "email", "phone", "website",
                                "address", F.col("vat_number").alias("vat"), "activity"))
    return _page_rows(spark, sf, "directory", record)


_CODE_LIST = O.joined(O.by_prefix("activity_code", 4, DEFAULT_RULES.activity_codes))


def _register_record(name: str) -> Column:
    return F.to_json(F.struct(
        F.col("k").cast("string").alias("id"), _named().alias(name), F.col("vat_number").alias("taxNumber"),
        F.col("registration_number").alias("registrationNumber"), F.col("address").alias("seat"),
        F.col("activity_code").alias("teaorCode"), F.col("activity").alias("teaorText"), "website", "email", "phone"))


def _register_sql(path: str, personal: str) -> str:
    return O.sql(f"""SELECT {_POS}, trim(legal_name) AS legal_name, {_TEXT.format('activity')} AS classification_text,
      concat('{path}/', k) AS source_url, email, phone, website, address, vat_number, registration_number,
      {_CODE_LIST} AS category_list, {personal} AS is_personal_data FROM raw WHERE k % 29 <> 0""", "raw")


def _register(spark, sf, source: str, name: str) -> DataFrame:
    pages = _page_rows(spark, sf, source, _register_record(name))
    rows = _parsed(spark, sf, source, pages, "email", "phone", "website", "address", "vat_number",
                   "registration_number", "categories", "is_personal_data")
    return rows.withColumn("category_list", joined("categories")).drop("categories").withColumn(
        "is_personal_data", F.coalesce("is_personal_data", F.lit(False)))


@query(_register_sql("https://companies.example/cegadat", "false"))
def parse_registry_pages(spark, sf):
    return _register(spark, sf, "ebeszamolo", "companyName")


@query(_register_sql("https://soletraders.example/ev", "true"))
def parse_sole_trader_pages(spark, sf):
    return _register(spark, sf, "evny", "name")


_AWARD_CODES = "CASE k % 4 WHEN 0 THEN '90919200-4' WHEN 1 THEN '72500000-0' WHEN 2 THEN '03000000-1' END"


@query(O.sql(f"""SELECT {_POS}, trim(legal_name) AS legal_name, {_TEXT.format('activity')} AS classification_text,
  concat('https://awards.example/eljaras/', k) AS source_url, address, vat_number,
  CASE k % 4 WHEN 0 THEN 'cleaning,security' WHEN 1 THEN 'it-support,security' WHEN 2 THEN 'security' ELSE '' END
  AS category_list FROM raw WHERE k % 29 <> 0""", "raw"))
def parse_award_pages(spark, sf):
    codes = F.expr(f"CASE WHEN k % 4 <> 3 THEN array({_AWARD_CODES}, '79713000-5', 'n/a') END")
    record = F.to_json(F.struct(F.col("k").alias("id"), _named().alias("supplierName"),
                                F.col("vat_number").alias("supplierVat"),
                                F.col("address").alias("supplierAddress"), codes.alias("cpvCodes"),
                                F.col("activity").alias("title")))
    pages = _page_rows(spark, sf, "kozbeszerzes", record)
    rows = _parsed(spark, sf, "kozbeszerzes", pages, "address", "vat_number", "categories")
    return rows.withColumn("category_list", joined("categories")).drop("categories")


# Tags of a point of interest, under their alternative names.
_POI_TAGS = """map_filter(map(
  'name', CASE WHEN k % 3 = 0 THEN legal_name WHEN k % 3 = 1 THEN '' END,
  'name:hu', CASE WHEN k % 3 = 1 THEN legal_name END,
  'operator', CASE WHEN k % 3 = 2 AND k % 29 <> 0 THEN legal_name WHEN k % 5 = 0 THEN 'Operátor Kft.' END,
  'contact:email', email, 'email', 'fallback@x.hu', 'phone', phone, 'website', website,
  'addr:postcode', CASE WHEN k % 2 = 0 THEN '1051' END, 'addr:city', CASE WHEN k % 3 <> 0 THEN 'Budapest' END,
  'addr:street', CASE WHEN k % 5 <> 0 THEN 'Fő utca' END, 'addr:housenumber', CASE WHEN k % 7 <> 0 THEN '12' END,
  'ref:vatin', vat_number, 'office', activity, 'craft', CASE WHEN k % 4 = 0 THEN 'hvac' END), (t, v) -> v IS NOT NULL)"""

_POI_NAME = "CASE WHEN k % 3 = 2 AND k % 29 = 0 AND k % 5 = 0 THEN 'Operátor Kft.' ELSE legal_name END"
_POI_OPERATOR = "CASE WHEN k % 3 = 2 AND k % 29 <> 0 THEN legal_name WHEN k % 5 = 0 THEN 'Operátor Kft.' END"


@query(O.sql(f"""SELECT {_POS}, poi_name AS legal_name,
  trim(concat(concat_ws(' ', nullif(activity, ''), CASE WHEN k % 4 = 0 THEN 'hvac' END), ' ', poi_name)) AS classification_text,
  concat('https://www.openstreetmap.org/node/', k) AS source_url,
  CASE WHEN operator <> poi_name THEN operator END AS brand_name,
  coalesce(email, 'fallback@x.hu') AS email, phone, website,
  nullif(concat_ws(', ', CASE WHEN k % 2 = 0 THEN '1051' END, CASE WHEN k % 3 <> 0 THEN 'Budapest' END,
    nullif(concat_ws(' ', CASE WHEN k % 5 <> 0 THEN 'Fő utca' END, CASE WHEN k % 7 <> 0 THEN '12' END), '')), '') AS address,
  regexp_replace(vat_number, '^HU', '') AS vat_number
  FROM (SELECT *, {_POI_NAME} AS poi_name, {_POI_OPERATOR} AS operator FROM raw
        WHERE NOT (k % 3 = 2 AND k % 29 = 0 AND k % 5 <> 0)) r""", "raw"))
def parse_poi_pages(spark, sf):
    element = F.to_json(F.struct(F.lit("node").alias("type"), F.col("k").alias("id"),
                                 F.expr(_POI_TAGS).alias("tags")))
    pages = _page_rows(spark, sf, "overpass", element).withColumn(
        "body", F.replace("body", F.lit('"results":'), F.lit('"elements":')))
    return _parsed(spark, sf, "overpass", pages, "brand_name", "email", "phone", "website", "address",
                   "vat_number")


_CARD = """concat('<', tag, ' class="card biz" data-id="', k, '"><h2 class="name"> ',
  CASE WHEN k % 29 = 0 THEN '' ELSE replace(legal_name, '&', '&amp;') END, '</h2><span class="cat">', coalesce(activity, ''),
  '</span>', CASE WHEN email IS NULL THEN '<span class="email">no@mail.hu</span>'
  ELSE concat('<a class="email" href="MAILTO:', email, '">mail</a>') END,
  '<span class="phone">', coalesce(phone, ''), '</span><a class="x web" href="', coalesce(website, ''), '">web</a>',
  '<p class="addr">', coalesce(address, ''), '</p></', tag, '>') """


@query(O.sql(f"""SELECT {_POS}, trim(legal_name) AS legal_name, {_TEXT.format('activity')} AS classification_text,
  concat('https://listing.example/biz/', k) AS source_url, coalesce(email, 'no@mail.hu') AS email,
  nullif(trim(phone), '') AS phone, nullif(website, '') AS website, nullif(trim(address), '') AS address
  FROM raw WHERE k % 29 <> 0""", "raw"))
def parse_listing_html(spark, sf):
    rows = S.raw_business(spark, sf).withColumn(
        "tag", F.expr("CASE k % 3 WHEN 0 THEN 'li' WHEN 1 THEN 'div' ELSE 'ARTICLE' END"))
    cards = rows.select("source", "crawl_region", "page", "pos", "k", F.expr(_CARD).alias("j"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "k", "j"))), lambda x: x["j"]), "\n")
    pages = cards.groupBy("source", "crawl_region", "page").agg(body.alias("body")).select(
        F.lit("htmldir").alias("source"), F.concat_ws("/", "source", "crawl_region").alias("region_id"), "page",
        F.concat(F.lit("<ul>"), "body", F.lit("</ul>")).alias("body"))
    return _parsed(spark, sf, "htmldir", pages, "email", "phone", "website", "address")


@query(O.sql("SELECT core, valid, address FROM vat_register", "vat_register"))
def parse_vat_register(spark, sf):
    return W.vat_register(spark, sf).select("core", "valid", "address")


@query(O.sql("SELECT core, tax_status, debt_free, employee_count FROM tax_signals", "tax_signals"))
def parse_tax_signals(spark, sf):
    return W.tax_signals(spark, sf)


@query(O.sql("SELECT name, phone, website, address FROM places", "places"))
def parse_places(spark, sf):
    return W.places(spark, sf)


@query(O.sql("SELECT domain, concat(email, ',iroda@', domain) AS emails, phone AS phones FROM contacts", "contacts"))
def merge_contact_pages(spark, sf):
    return W.contacts(spark, sf).select("domain", F.array_join("emails", ",").alias("emails"),
                                        F.array_join("phones", ",").alias("phones"))


# -- pages and cursors ---------------------------------------------------------------

_STARTS = """SELECT w.source, w.region_id, cast(coalesce(nullif(c.last_page, 0), 1) AS int) AS start_page
  FROM (SELECT DISTINCT source, region_id FROM pg) w LEFT JOIN cur c USING (source, region_id)"""

# The run by counting along the pages: it goes on while page - rank stays put.
_PREFIX = """SELECT s.source, s.region_id, start_page, cast(start_page - 1 + count(p.page) AS int) AS last_page
  FROM starts s LEFT JOIN (
    SELECT source, region_id, page FROM (
      SELECT q.*, row_number() OVER (PARTITION BY source, region_id ORDER BY page) AS rn FROM (
        SELECT pg.source, pg.region_id, page, start_page,
               min(CASE WHEN n_rows = 0 THEN page END) OVER (PARTITION BY pg.source, pg.region_id) AS first_empty
        FROM pg JOIN starts ON pg.source = starts.source AND pg.region_id = starts.region_id
        WHERE page >= start_page AND page <= 30) q) r
    WHERE page - rn = start_page - 1 AND (first_empty IS NULL OR page < first_empty)) p
  ON p.source = s.source AND p.region_id = s.region_id
  GROUP BY s.source, s.region_id, start_page"""


def _starts(spark, sf) -> DataFrame:
    wanted = S.crawl_pages(spark, sf).select("source", "region_id").distinct()
    return P.resume_cursor(wanted, S.cursors(spark, sf))


def _prefix(spark, sf) -> DataFrame:
    return P.page_prefix(S.crawl_pages(spark, sf), _starts(spark, sf), max_pages=30)


@query(O.sql(_STARTS, "pg", "cur"))
def resume_cursor(spark, sf):
    return _starts(spark, sf)


@query(O.sql("SELECT source, region_id, start_page, last_page FROM prefix", "pg", "cur", starts=_STARTS, prefix=_PREFIX))
def page_prefix(spark, sf):
    return _prefix(spark, sf).drop("failed")


@query(O.sql("""SELECT pg.source, pg.region_id, count(*) AS n_pages, cast(sum(n_rows) AS bigint) AS n_rows
  FROM pg JOIN prefix p ON pg.source = p.source AND pg.region_id = p.region_id
  WHERE page BETWEEN start_page AND last_page GROUP BY 1, 2""", "pg", "cur", starts=_STARTS, prefix=_PREFIX))
def pages_in_prefix(spark, sf):
    kept = P.keep_prefix(S.crawl_pages(spark, sf), _prefix(spark, sf))
    return kept.groupBy("source", "region_id").agg(F.count(F.lit(1)).alias("n_pages"),
                                                   F.sum("n_rows").alias("n_rows"))


@query(O.sql("""SELECT coalesce(c.source, p.source) AS source, coalesce(c.region_id, p.region_id) AS region_id,
  cast(greatest(c.last_page, p.last_page) AS int) AS last_page,
  cast(coalesce(total_seen, 0) + coalesce(p.last_page - p.start_page + 1, 0) AS bigint) AS total_seen
  FROM cur c FULL JOIN prefix p ON c.source = p.source AND c.region_id = p.region_id""",
             "pg", "cur", starts=_STARTS, prefix=_PREFIX))
def save_cursor(spark, sf):
    seen = _prefix(spark, sf).select("source", "region_id", "last_page",
                                     (F.col("last_page") - F.col("start_page") + 1).alias("n_seen"))
    return P.save_cursor(S.cursors(spark, sf), seen, W.now()).drop("last_run_at")


@query(O.sql("""SELECT region_id, page, pos FROM (SELECT concat(source, '/', crawl_region) AS region_id, page,
    cast(row_number() OVER (PARTITION BY source, crawl_region, page ORDER BY pos, k) - 1 AS int) AS pos,
    row_number() OVER (PARTITION BY source, crawl_region ORDER BY page, pos, k) AS rn FROM raw WHERE k % 29 <> 0) r
  WHERE rn <= 25""", "raw"))
def record_limit(spark, sf):
    parsed = parse_pages(_directory_pages(spark, sf), get_source("directory"))
    cut = P.record_limit(parsed, row_counts(parsed), {"directory": 25})
    return explode_records(cut).select(F.col("crawl_region").alias("region_id"), "page", "pos")


@query(O.sql("SELECT source, region_id, last_page, total_seen FROM cur", "cur"))
def cursor_listing(spark, sf):
    return R.cursor_listing(S.cursors(spark, sf))


# -- suppression ------------------------------------------------------------------------

@query(O.sql("SELECT source, k, dedupe_key FROM flagged WHERE NOT suppressed", "flagged"))
def anti_suppressed(spark, sf):
    return U.anti_suppressed(W.batch(spark, sf), S.suppression(spark, sf)).select("source", "k", "dedupe_key")


@query(O.sql("SELECT source, suppressed, count(*) AS n FROM flagged GROUP BY 1, 2", "flagged"))
def flag_suppressed(spark, sf):
    flagged = U.flag_suppressed(W.batch(spark, sf), S.suppression(spark, sf))
    return flagged.groupBy("source", "suppressed").agg(F.count(F.lit(1)).alias("n"))


@query(O.sql("""SELECT source, k, email FROM keyed WHERE email IN (SELECT value FROM sup)
  OR split_part(email, '@', 2) IN (SELECT value FROM sup)""", "keyed", "sup"))
def is_suppressed(spark, sf):
    rows = W.normalised(spark, sf).select("source", "k", "email")
    return U.is_suppressed(rows, S.suppression(spark, sf))


@query(O.sql("SELECT source, k, domain FROM keyed WHERE domain IN (SELECT value FROM sup WHERE kind = 'DOMAIN')",
             "keyed", "sup"))
def is_domain_suppressed(spark, sf):
    rows = W.normalised(spark, sf).select("source", "k", "domain")
    return U.is_domain_suppressed(rows, S.suppression(spark, sf))


# New entries: messy sites without a kind, and addresses that are listed already.
_ENTRIES = """SELECT concat('https://www.CEG', cast(s_suppkey * 4 AS varchar(20)), '.hu/x') AS value,
  cast(NULL AS varchar(20)) AS kind, 'second' AS reason, s_suppkey * 2 AS ord FROM {0} WHERE s_suppkey % 3 = 0
  UNION ALL
  SELECT concat(' Iroda', cast(s_suppkey * 7 + 4 AS varchar(20)), '@Kozos.HU') AS value,
  cast(NULL AS varchar(20)) AS kind, CASE WHEN s_suppkey % 2 = 0 THEN 'third' END AS reason, s_suppkey * 2 + 1 AS ord
  FROM {0} WHERE s_suppkey % 5 < 3"""


@query(O.sql(f"""SELECT value, arg_min(kind, ord) AS kind, arg_max(reason, ord) AS reason FROM (
  SELECT value, kind, reason, -1 AS ord FROM sup UNION ALL
  SELECT CASE WHEN contains(value, '@') THEN lower(trim(value)) ELSE coalesce({O.domain('value')}, lower(trim(value))) END,
         CASE WHEN contains(value, '@') THEN 'EMAIL' ELSE 'DOMAIN' END, coalesce(reason, 'manual'), ord FROM entries) u
  GROUP BY value""", "sup", entries=_ENTRIES.format("supplier")))
def add_suppression(spark, sf):
    entries = spark.sql(_ENTRIES.format(S.at(sf, "supplier")))
    return U.add_suppression(S.suppression(spark, sf), entries, W.now()).drop("created_at")


# -- consolidation -----------------------------------------------------------------------

_MERGED_COLUMNS = ["dedupe_key", "legal_name", "source", "source_url", "source_license", *M.GAPS,
                   "classification_text", "is_personal_data"]


@query(O.sql(f"SELECT {', '.join(_MERGED_COLUMNS)}, {O.joined('categories')} AS categories, input_count, first_seq "
             "FROM merged", "merged"))
def dedupe_batch(spark, sf):
    return W.merged(spark, sf).select(*_MERGED_COLUMNS, joined("categories").alias("categories"),
                                      "input_count", "first_seq")


# Two batches: customers are stored first, then suppliers arrive.
_FIRST, _SECOND = "SELECT * FROM keyed WHERE source = 'ebeszamolo'", "SELECT * FROM keyed WHERE source = 'directory'"
_TWO = {"b1": _FIRST, "b2": _SECOND, "m1": O.merged("b1"), "m2": O.merged("b2")}


def _two_batches(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = W.batch(spark, sf)
    first = M.dedupe_batch(rows.filter("source = 'ebeszamolo'"), seq="seqno")
    second = M.dedupe_batch(rows.filter("source = 'directory'"), seq="seqno")
    return M.upsert_lead(spark.createDataFrame([], M.LEAD), first, W.now()), second


@query(O.sql("""SELECT count(CASE WHEN m1.dedupe_key IS NULL THEN 1 END) AS created,
  cast(sum(CASE WHEN m1.dedupe_key IS NULL THEN m2.input_count - 1 ELSE m2.input_count END) AS bigint) AS merged
  FROM m2 LEFT JOIN m1 ON m1.dedupe_key = m2.dedupe_key""", "keyed", **_TWO))
def ingest_stats(spark, sf):
    lead, second = _two_batches(spark, sf)
    return M.ingest_stats(M.match_existing(second, lead))


@query(O.sql("""SELECT m2.dedupe_key, m2.input_count, m1.dedupe_key IS NOT NULL AS known
  FROM m2 LEFT JOIN m1 ON m1.dedupe_key = m2.dedupe_key""", "keyed", **_TWO))
def match_existing(spark, sf):
    lead, second = _two_batches(spark, sf)
    return M.match_existing(second, lead).select("dedupe_key", "input_count", "known")


_UPSERT = f"""SELECT coalesce(m1.dedupe_key, m2.dedupe_key) AS dedupe_key,
  CASE WHEN m1.dedupe_key IS NULL THEN m2.legal_name ELSE m1.legal_name END AS legal_name,
  CASE WHEN m1.dedupe_key IS NULL THEN m2.source ELSE m1.source END AS source,
  CASE WHEN m1.dedupe_key IS NULL THEN m2.source_url ELSE m1.source_url END AS source_url,
  CASE WHEN m1.dedupe_key IS NULL THEN m2.source_license ELSE m1.source_license END AS source_license,
  {', '.join(f'coalesce(m1.{g}, m2.{g}) AS {g}' for g in M.GAPS)},
  CASE WHEN coalesce(length(m2.classification_text), 0) > coalesce(length(m1.classification_text), 0)
       THEN m2.classification_text ELSE coalesce(m1.classification_text, m2.classification_text) END AS classification_text,
  list_distinct(list_concat(coalesce(m1.categories, []), coalesce(m2.categories, []))) AS categories,
  coalesce(m1.is_personal_data, false) OR coalesce(m2.is_personal_data, false) AS is_personal_data
  FROM m1 FULL JOIN m2 ON m1.dedupe_key = m2.dedupe_key"""


@query(O.sql(f"""SELECT sha256(dedupe_key) AS lead_id, {', '.join(_MERGED_COLUMNS)}, {O.joined('categories')} AS categories,
  {O.score()} AS quality_score, 'PENDING' AS review_status, 'NEW' AS lifecycle,
  '1999-06-01T12:00:00.000Z' AS collected_at FROM up""", "keyed", **_TWO, up=_UPSERT))
def upsert_lead(spark, sf):
    lead, second = _two_batches(spark, sf)
    out = M.upsert_lead(lead, second, W.now())
    return out.select("lead_id", *_MERGED_COLUMNS, joined("categories").alias("categories"), "quality_score",
                      "review_status", "lifecycle", stamp("collected_at"))


@query(O.sql("""SELECT f.source, count(*) AS fetched, coalesce(any_value(c.created), 0) AS created,
  count(*) - count(CASE WHEN suppressed THEN 1 END) - coalesce(any_value(c.created), 0) AS merged,
  count(CASE WHEN suppressed THEN 1 END) AS skipped
  FROM flagged f LEFT JOIN (SELECT source, count(*) AS created FROM kept GROUP BY source) c ON c.source = f.source
  GROUP BY f.source""", "flagged", clean="SELECT * FROM flagged WHERE NOT suppressed", kept=O.merged("clean")))
def refresh_summary(spark, sf):
    batch = U.flag_suppressed(W.batch(spark, sf), S.suppression(spark, sf))
    kept = M.dedupe_batch(batch.filter(~F.col("suppressed")), seq="seqno").withColumn("known", F.lit(False))
    return R.batch_by_source(batch, kept)


# -- read side ---------------------------------------------------------------------------

@query(O.sql("SELECT dedupe_key, quality_score FROM lead", "lead"))
def quality_score(spark, sf):
    return W.lead(spark, sf).select("dedupe_key", "quality_score")


@query(O.sql("""SELECT count(*) AS total, count(email) AS with_email, count(CASE WHEN is_personal_data THEN 1 END) AS personal_data,
  count(CASE WHEN review_status = 'PENDING' THEN 1 END) AS pending, count(CASE WHEN review_status = 'APPROVED' THEN 1 END) AS approved,
  count(CASE WHEN review_status = 'REJECTED' THEN 1 END) AS rejected, count(last_verified_at) AS vies_verified,
  count(nav_checked_at) AS nav_checked, count(contact_checked_at) AS contact_checked, count(places_checked_at) AS places_checked,
  count(CASE WHEN quality_score >= 70 THEN 1 END) AS quality_high,
  count(CASE WHEN quality_score < 70 AND quality_score >= 40 THEN 1 END) AS quality_medium,
  count(CASE WHEN quality_score < 40 THEN 1 END) AS quality_low FROM lead""", "lead"))
def coverage_report(spark, sf):
    return R.coverage_report(W.lead(spark, sf))


@query(O.sql("SELECT source, count(*) AS n FROM merged GROUP BY source", "merged"))
def coverage_by_source(spark, sf):
    return R.coverage_by_source(W.merged(spark, sf))


@query(O.sql("""SELECT count(*) AS total, count(email) AS with_email, count(CASE WHEN is_personal_data THEN 1 END) AS personal_data,
  count(CASE WHEN review_status = 'PENDING' THEN 1 END) AS pending, count(CASE WHEN review_status = 'APPROVED' THEN 1 END) AS approved,
  count(CASE WHEN review_status = 'REJECTED' THEN 1 END) AS rejected, count(nav_checked_at) AS nav_checked,
  count(CASE WHEN tax_status = 'ACTIVE' THEN 1 END) AS active, count(CASE WHEN debt_free THEN 1 END) AS debt_free,
  (SELECT count(*) FROM sup) AS suppression_entries FROM lead""", "lead", "sup"))
def lead_stats(spark, sf):
    return R.lead_stats(W.lead(spark, sf), S.suppression(spark, sf))


def _labels(items) -> str:
    rows = ", ".join(f"({i}, {O.quoted(x.id)}, {O.quoted(x.name)})" for i, x in enumerate(items))
    return f"SELECT * FROM (VALUES {rows}) v(ord, id, name)"


@query(O.sql("""SELECT ord, id, name, n FROM labels_ JOIN (SELECT region_id, count(*) AS n FROM merged GROUP BY region_id) c
  ON c.region_id = id""", "merged", labels_=_labels(DEFAULT_RULES.regions)))
def stats_by_region(spark, sf):
    return R.stats_by_region(W.merged(spark, sf))


@query(O.sql("""SELECT ord, id, name, n FROM labels_ JOIN (SELECT c, count(*) AS n FROM
  (SELECT unnest(categories) AS c FROM merged) u GROUP BY c) x ON x.c = id""", "merged",
             labels_=_labels(DEFAULT_RULES.categories)))
def stats_by_category(spark, sf):
    return R.stats_by_category(W.merged(spark, sf))


@query(O.sql("""SELECT source, source_license, count(*) AS n_rows, count(CASE WHEN is_personal_data THEN 1 END) AS n_personal
  FROM merged GROUP BY source, source_license""", "merged"))
def source_register(spark, sf):
    return R.source_register(W.merged(spark, sf))


# A category is filtered after the cut to the best 200.
@query(O.sql(f"""SELECT lead_id, quality_score, legal_name, region_id, {O.joined('categories')} AS categories,
  coalesce(email, phone) AS contact, is_personal_data FROM (
  SELECT * FROM lead WHERE region_id = 'pest' AND quality_score >= 30 ORDER BY quality_score DESC, lead_id LIMIT 200) t
  WHERE list_contains(categories, 'cleaning')""", "lead"))
def list_leads(spark, sf):
    out = V.list_leads(W.lead(spark, sf), region="pest", category="cleaning", min_quality=30, limit=200)
    return out.withColumn("categories", joined("categories"))


def _reasons_sql() -> str:
    items = [f"CASE WHEN is_personal_data THEN {O.quoted(Q.PERSONAL)} END",
             f"CASE WHEN coalesce(email, '') = '' AND coalesce(phone, '') = '' THEN {O.quoted(Q.NO_CHANNEL)} END",
             f"CASE WHEN len(categories) = 0 THEN {O.quoted(Q.UNCATEGORISED)} END",
             f"CASE WHEN quality_score < 40 THEN {O.quoted(Q.LOW)} END"]
    return f"array_to_string(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL), '; ')"


@query(O.sql(f"""SELECT lead_id, legal_name, region_id, {O.joined('categories')} AS categories, quality_score,
  is_personal_data, coalesce(email, phone) AS contact, {_reasons_sql()} AS reasons
  FROM lead WHERE review_status = 'PENDING'""", "lead"))
def review_queue(spark, sf):
    out = V.review_queue(W.lead(spark, sf))
    return out.withColumn("categories", joined("categories")).withColumn("reasons", F.array_join("reasons", "; "))


@query(O.sql("""SELECT lead_id, quality_score FROM lead WHERE review_status = 'PENDING' AND region_id = 'budapest'
  AND list_contains(categories, 'security') ORDER BY is_personal_data, quality_score DESC, lead_id LIMIT 20""", "lead"))
def queue_order(spark, sf):
    return V.review_queue(W.lead(spark, sf), region="budapest", category="security", limit=20).select(
        "lead_id", "quality_score")


@query(O.sql(f"""SELECT lead_id, CASE WHEN tax_status = 'CANCELLED' AND NOT debt_free THEN '{Q.TAX_CANCELLED}; {Q.TAX_DEBT}'
  WHEN tax_status = 'CANCELLED' THEN '{Q.TAX_CANCELLED}' WHEN NOT debt_free THEN '{Q.TAX_DEBT}' ELSE '' END AS reasons
  FROM lead""", "lead"))
def tax_risk_reasons(spark, sf):
    reasons = Q.tax_risk_reasons(F.col("tax_status"), F.col("debt_free"))
    return W.lead(spark, sf).select("lead_id", F.array_join(reasons, "; ").alias("reasons"))


@query(O.sql(f"""SELECT lead_id AS "externalId", legal_name AS "legalName", vat_number AS "vatNumber",
  registration_number AS "registrationNumber", region_id AS "regionId", {O.joined('categories')} AS categories, email, phone,
  website, quality_score AS "qualityScore", tax_status AS "taxStatus", debt_free AS "debtFree", source
  FROM lead WHERE quality_score >= 40 AND review_status <> 'REJECTED' AND NOT is_personal_data""", "lead"))
def export_record(spark, sf):
    rows = X.export_filter(W.lead(spark, sf), min_quality=40)
    return X.export_record(rows).withColumn("categories", joined("categories"))


_DECISIONS = """SELECT dedupe_key, CASE WHEN quality_score >= 50 THEN 'approve' ELSE 'reject' END AS action,
  CASE WHEN quality_score < 50 THEN 'weak' END AS note FROM {0} WHERE quality_score % 20 = 0"""


@query(O.sql("""SELECT l.lead_id, CASE WHEN d.action = 'approve' THEN 'APPROVED' WHEN d.action = 'reject' THEN 'REJECTED'
  ELSE review_status END AS review_status, d.note AS review_note,
  CASE WHEN d.action IS NOT NULL THEN '1999-06-01T12:00:00.000Z' END AS reviewed_at
  FROM lead l LEFT JOIN d ON d.dedupe_key = l.dedupe_key""", "lead", d=_DECISIONS.format("lead")))
def set_review(spark, sf):
    lead = W.lead(spark, sf)
    action = F.when(F.col("quality_score") >= 50, "approve").otherwise("reject")
    decisions = lead.filter(F.col("quality_score") % 20 == 0).select(
        "lead_id", action.alias("action"), F.when(F.col("quality_score") < 50, "weak").alias("note"),
        F.lit(1).alias("ord"))
    out = E.apply_outcome(lead, V.set_review(lead, decisions, W.now()), V.REVIEW_COLUMNS)
    return out.select("lead_id", "review_status", "review_note", stamp("reviewed_at"))


# -- enrichment ---------------------------------------------------------------------------

def _after(columns: str, patched: str, joins: str, condition: str) -> str:
    return f"SELECT l.lead_id, {columns} FROM lead l LEFT JOIN ({patched}) p ON {joins} AND {condition}"


_VAT_CANDIDATE = f"l.vat_number IS NOT NULL AND l.last_verified_at IS NULL"
_VAT_JOIN = f"p.core = {O.vat_core('l.vat_number')}"
_NEW = "CASE WHEN p.{0} THEN '1999-06-01T12:00:00.000Z' ELSE " + O.iso("l.{1}") + " END AS {1}"

_VERIFIED = f"""SELECT l.* REPLACE (CASE WHEN p.valid AND coalesce(l.address, '') = '' AND p.address IS NOT NULL THEN p.address
    ELSE l.address END AS address), l.quality_score AS old_score, p.core AS hit, p.valid,
    p.valid AND coalesce(l.address, '') = '' AND p.address IS NOT NULL AS changed, {_VAT_CANDIDATE} AS candidate
  FROM lead l LEFT JOIN vat_register p ON {_VAT_JOIN} AND {_VAT_CANDIDATE}"""


@query(O.sql(f"""SELECT lead_id, address, CASE WHEN changed THEN {O.score()} ELSE old_score END AS quality_score,
  CASE WHEN hit IS NOT NULL THEN '1999-06-01T12:00:00.000Z' ELSE {O.iso('last_verified_at')} END AS last_verified_at
  FROM v""", "lead", "vat_register", v=_VERIFIED))
def verify_vat(spark, sf):
    lead = W.lead(spark, sf)
    outcome = E.verify_vat(lead, W.vat_register(spark, sf), W.now())
    return E.apply_outcome(lead, outcome, E.VAT_COLUMNS).select(
        "lead_id", "address", "quality_score", stamp("last_verified_at"))


@query(O.sql("""SELECT count(CASE WHEN candidate THEN 1 END) AS scanned, count(CASE WHEN valid THEN 1 END) AS valid,
  count(CASE WHEN hit IS NOT NULL AND NOT valid THEN 1 END) AS invalid, count(CASE WHEN changed THEN 1 END) AS enriched,
  count(CASE WHEN candidate AND hit IS NULL THEN 1 END) AS skipped FROM v""", "lead", "vat_register", v=_VERIFIED))
def vat_stats(spark, sf):
    return E.vat_stats(E.verify_vat(W.lead(spark, sf), W.vat_register(spark, sf), W.now()))


_TAX_CANDIDATE = "l.vat_number IS NOT NULL AND l.nav_checked_at IS NULL"
_TAXED = f"""SELECT l.lead_id, p.core AS hit, {_TAX_CANDIDATE} AS candidate, l.nav_checked_at AS old_check,
    CASE WHEN p.core IS NULL THEN l.tax_status ELSE p.tax_status END AS tax_status,
    CASE WHEN p.core IS NULL THEN l.debt_free ELSE p.debt_free END AS debt_free, p.employee_count,
    p.tax_status AS new_status, p.debt_free AS new_debt
  FROM lead l LEFT JOIN tax_signals p ON {_VAT_JOIN} AND {_TAX_CANDIDATE}"""


@query(O.sql(f"""SELECT lead_id, tax_status, debt_free, employee_count,
  CASE WHEN hit IS NOT NULL THEN '1999-06-01T12:00:00.000Z' ELSE {O.iso('old_check')} END AS nav_checked_at FROM v""",
             "lead", "tax_signals", v=_TAXED))
def check_tax(spark, sf):
    lead = W.lead(spark, sf)
    outcome = E.check_tax(lead, W.tax_signals(spark, sf), W.now())
    return E.apply_outcome(lead, outcome, E.TAX_COLUMNS).select(
        "lead_id", "tax_status", "debt_free", "employee_count", stamp("nav_checked_at"))


@query(O.sql("""SELECT count(CASE WHEN candidate THEN 1 END) AS scanned, count(hit) AS checked,
  count(CASE WHEN new_status = 'ACTIVE' THEN 1 END) AS active, count(CASE WHEN new_status = 'SUSPENDED' THEN 1 END) AS suspended,
  count(CASE WHEN new_status = 'CANCELLED' THEN 1 END) AS cancelled, count(CASE WHEN new_debt THEN 1 END) AS debt_free,
  count(CASE WHEN candidate AND hit IS NULL THEN 1 END) AS skipped FROM v""", "lead", "tax_signals", v=_TAXED))
def tax_stats(spark, sf):
    return E.tax_stats(E.check_tax(W.lead(spark, sf), W.tax_signals(spark, sf), W.now()))


_CONTACT_CANDIDATE = "l.domain IS NOT NULL AND (l.email IS NULL OR l.phone IS NULL) AND l.contact_checked_at IS NULL"
_CONTACTED = f"""SELECT l.* REPLACE (coalesce(l.email, p.email) AS email, coalesce(l.phone, p.phone) AS phone),
    l.quality_score AS old_score, p.domain AS hit, {_CONTACT_CANDIDATE} AS candidate,
    l.email IS NULL AND p.email IS NOT NULL AS new_email, l.phone IS NULL AND p.phone IS NOT NULL AS new_phone
  FROM lead l LEFT JOIN contacts p ON p.domain = l.domain AND {_CONTACT_CANDIDATE}"""


@query(O.sql(f"""SELECT lead_id, email, phone,
  CASE WHEN new_email OR new_phone THEN {O.score()} ELSE old_score END AS quality_score,
  CASE WHEN hit IS NOT NULL THEN '1999-06-01T12:00:00.000Z' ELSE {O.iso('contact_checked_at')} END AS contact_checked_at
  FROM v""", "lead", "contacts", v=_CONTACTED))
def enrich_contacts(spark, sf):
    lead = W.lead(spark, sf)
    outcome = E.enrich_contacts(lead, W.contacts(spark, sf), W.now())
    return E.apply_outcome(lead, outcome, E.CONTACT_COLUMNS).select(
        "lead_id", "email", "phone", "quality_score", stamp("contact_checked_at"))


@query(O.sql("""SELECT count(CASE WHEN candidate THEN 1 END) AS scanned, count(CASE WHEN new_email OR new_phone THEN 1 END) AS enriched,
  count(CASE WHEN new_email THEN 1 END) AS emails_added, count(CASE WHEN new_phone THEN 1 END) AS phones_added,
  count(CASE WHEN candidate AND hit IS NULL THEN 1 END) AS skipped FROM v""", "lead", "contacts", v=_CONTACTED))
def contact_stats(spark, sf):
    return E.contact_stats(E.enrich_contacts(W.lead(spark, sf), W.contacts(spark, sf), W.now()))


_PLACE_CANDIDATE = "(l.phone IS NULL OR l.website IS NULL) AND l.places_checked_at IS NULL"
_PLACED = f"""SELECT l.* REPLACE (coalesce(l.phone, p.phone) AS phone, coalesce(l.website, p.website) AS website,
    CASE WHEN l.website IS NULL AND p.website IS NOT NULL THEN p.domain ELSE l.domain END AS domain,
    coalesce(l.address, p.address) AS address), l.quality_score AS old_score, p.name AS hit, candidate,
    l.phone IS NULL AND p.phone IS NOT NULL AS new_phone, l.website IS NULL AND p.website IS NOT NULL AS new_website,
    l.address IS NULL AND p.address IS NOT NULL AS new_address
  FROM (SELECT l.*, candidate, coalesce(a.name, b.name) AS place FROM
        (SELECT l.*, {_PLACE_CANDIDATE} AS candidate, {O.company_name('l.legal_name')} AS norm_name FROM lead l) l
        LEFT JOIN places a ON a.name = l.legal_name AND candidate LEFT JOIN places b ON b.name = l.norm_name AND candidate) l
  LEFT JOIN places p ON p.name = l.place"""


@query(O.sql(f"""SELECT lead_id, phone, website, domain, address,
  CASE WHEN new_phone OR new_website OR new_address THEN {O.score()} ELSE old_score END AS quality_score,
  CASE WHEN hit IS NOT NULL THEN '1999-06-01T12:00:00.000Z' ELSE {O.iso('places_checked_at')} END AS places_checked_at
  FROM v""", "lead", "places", v=_PLACED))
def enrich_places(spark, sf):
    lead = W.lead(spark, sf)
    outcome = E.enrich_places(lead, W.places(spark, sf), W.now())
    return E.apply_outcome(lead, outcome, E.PLACE_COLUMNS).select(
        "lead_id", "phone", "website", "domain", "address", "quality_score", stamp("places_checked_at"))


@query(O.sql("""SELECT count(CASE WHEN candidate THEN 1 END) AS scanned,
  count(CASE WHEN new_phone OR new_website OR new_address THEN 1 END) AS enriched, count(CASE WHEN new_phone THEN 1 END) AS phones_added,
  count(CASE WHEN new_website THEN 1 END) AS websites_added, count(CASE WHEN new_address THEN 1 END) AS addresses_added,
  count(CASE WHEN candidate AND hit IS NULL THEN 1 END) AS skipped FROM v""", "lead", "places", v=_PLACED))
def places_stats(spark, sf):
    return E.places_stats(E.enrich_places(W.lead(spark, sf), W.places(spark, sf), W.now()))


@query(O.sql(f"SELECT l.lead_id FROM lead l WHERE {_VAT_CANDIDATE} ORDER BY lead_id LIMIT 100", "lead"))
def candidate_limit(spark, sf):
    return E.candidates_vat_check(W.lead(spark, sf), limit=100).select("lead_id")


@query(O.sql(f"""SELECT count(CASE WHEN vat_number IS NOT NULL THEN 1 END) AS revalidated,
  count(CASE WHEN {_VAT_CANDIDATE} THEN 1 END) AS vat_check, count(CASE WHEN {_TAX_CANDIDATE} THEN 1 END) AS tax_check,
  count(CASE WHEN {_CONTACT_CANDIDATE} THEN 1 END) AS contact, count(CASE WHEN {_PLACE_CANDIDATE} THEN 1 END) AS places
  FROM lead l""", "lead"))
def candidates(spark, sf):
    lead = W.stored_lead(spark, sf)  # five narrow scans, no step of its making again
    kinds = [("revalidated", E.candidates_vat_check(lead, revalidate=True)), ("vat_check", E.candidates_vat_check(lead)),
             ("tax_check", E.candidates_tax_check(lead)), ("contact", E.candidates_contact(lead)),
             ("places", E.candidates_places(lead))]
    marked = None
    for kind, rows in kinds:
        one = rows.select(F.lit(kind).alias("kind"))
        marked = one if marked is None else marked.unionByName(one)
    return marked.agg(*[F.count_if(F.col("kind") == kind).alias(kind) for kind, _ in kinds])


# -- governance ---------------------------------------------------------------------------

_DECIDED = """SELECT l.*, CASE
    WHEN coalesce(email IN (SELECT value FROM sup), false) OR coalesce(split_part(email, '@', 2) IN (SELECT value FROM sup), false)
         OR coalesce(domain IN (SELECT value FROM sup), false) THEN 'SUPPRESSED'
    WHEN is_personal_data AND lifecycle = 'NEW'
         AND epoch_ms(TIMESTAMP '1999-06-01 12:00:00') - epoch_ms(collected_at) >= cast(365 AS bigint) * 86400000 THEN 'PERSONAL_DATA_EXPIRED'
    END AS reason FROM lead l"""


def _decided(spark, sf) -> tuple[DataFrame, DataFrame]:
    lead = W.lead(spark, sf)
    return lead, G.purge_candidates(lead, S.suppression(spark, sf), W.now())


@query(O.sql("SELECT lead_id, reason FROM v", "lead", "sup", v=_DECIDED))
def purge_decision(spark, sf):
    return _decided(spark, sf)[1].select("lead_id", "reason")


@query(O.sql("""SELECT count(*) AS scanned, count(CASE WHEN reason = 'SUPPRESSED' THEN 1 END) AS suppressed,
  count(CASE WHEN reason = 'PERSONAL_DATA_EXPIRED' THEN 1 END) AS expired FROM v""", "lead", "sup", v=_DECIDED))
def purge_stats(spark, sf):
    return G.purge_stats(_decided(spark, sf)[1])


@query(O.sql("SELECT lead_id, dedupe_key, source, quality_score FROM v WHERE reason IS NULL", "lead", "sup", v=_DECIDED))
def erase_leads(spark, sf):
    lead, decided = _decided(spark, sf)
    return G.erase_leads(lead, decided.filter("reason is not null")).select(
        "lead_id", "dedupe_key", "source", "quality_score")


_AUDIT = """SELECT cast(event_id AS varchar) AS event_id, CASE WHEN event_type <> 'signup' THEN sha256(dedupe_key) END AS lead_id,
  upper(event_type) AS type, props AS meta, ts AS created_at
  FROM events LEFT JOIN (SELECT k, dedupe_key FROM keyed WHERE source = 'ebeszamolo') r ON r.k = user_id"""


@query(O.sql("""SELECT event_id, a.lead_id, type FROM audit a WHERE a.lead_id IS NULL
  OR a.lead_id NOT IN (SELECT lead_id FROM v WHERE reason IS NOT NULL)""", "lead", "sup", audit=_AUDIT, v=_DECIDED))
def erase_events(spark, sf):
    _, decided = _decided(spark, sf)
    events = W.audit_events(spark, sf)
    return G.erase_events(events, decided.filter("reason is not null")).select("event_id", "lead_id", "type")


@query(O.sql("""SELECT cast(NULL AS varchar) AS lead_id, 'PURGED' AS type, concat('{"leadId":"', lead_id, '","source":"', source,
  '","regionId":"', region_id, '","reason":"', reason, '"}') AS meta FROM v WHERE reason IS NOT NULL""",
             "lead", "sup", v=_DECIDED))
def erasure_events(spark, sf):
    doomed = _decided(spark, sf)[1].filter("reason is not null")
    return G.erasure_events(doomed, "PURGED", W.now(), "run", reason=F.col("reason")).select("lead_id", "type", "meta")


@query(O.sql(f"""SELECT email AS subject, l.lead_id, legal_name, quality_score, type, meta, {O.iso('a.created_at')} AS created_at
  FROM lead l JOIN audit a ON a.lead_id = l.lead_id WHERE email IS NOT NULL""", "lead", audit=_AUDIT))
def dsar_export(spark, sf):
    """Access requests of all subjects at once, flat."""
    lead = W.lead(spark, sf)
    report = G.dsar_export(lead, W.audit_events(spark, sf), lead.filter("email is not null").select("email"))
    records = report.records.select("lead_id", "legal_name", "quality_score")
    return report.trail.join(records, "lead_id").select(
        "subject", "lead_id", "legal_name", "quality_score", "type", "meta", "created_at")


@query(O.sql(f"""SELECT l.lead_id, email AS subject, {O.iso('collected_at')} AS collected_at,
  count(a.event_id) OVER (PARTITION BY l.lead_id) AS trail_events, type, {O.iso('a.created_at')} AS created_at
  FROM lead l LEFT JOIN audit a ON a.lead_id = l.lead_id WHERE email IS NOT NULL""", "lead", audit=_AUDIT))
def dsar_documents(spark, sf):
    lead = W.lead(spark, sf)
    report = G.dsar_export(lead, W.audit_events(spark, sf), lead.filter("email is not null").select("email"))
    records = G.dsar_documents(report).select("lead_id", "subject", "collected_at", "trail_events")
    return records.join(report.trail.select("lead_id", "type", "created_at"), "lead_id", "left")


@query(O.sql("""SELECT l.lead_id FROM lead l WHERE email IS NULL OR email NOT IN (SELECT email FROM keyed
  WHERE email IS NOT NULL AND k % 3 = 0)""", "lead"))
def dsar_erase(spark, sf):
    """Master table after erasing every third record's subject."""
    lead = W.lead(spark, sf)
    subjects = W.batch(spark, sf).filter("email is not null and k % 3 = 0").select("email")
    held = lead.join(subjects.select(G.require_email(F.col("email")).alias("email")).distinct(), "email", "left_semi")
    return G.erase_leads(lead, held).select("lead_id")


# Newer rules: one category lost, one gained, for records and for documents.
_NEWER = RuleSet(
    categories=tuple(c for c in DEFAULT_RULES.categories if c.id != "hvac")
    + (Category("food", "food", ("pékség",), ("minta",)),), regions=DEFAULT_RULES.regions)
_RECAT = f"SELECT lead_id, categories AS previous, {O.classify(O.fold('classification_text'), _NEWER)} AS next FROM lead"


@query(O.sql(f"SELECT lead_id, {O.joined('previous')} AS previous, {O.joined('next')} AS categories, "
             "list_sort(previous) <> list_sort(next) AS changed FROM v", "lead", v=_RECAT))
def recategorize(spark, sf):
    out = G.recategorize(W.lead(spark, sf), _NEWER)
    return out.select("lead_id", joined("previous").alias("previous"), joined("categories").alias("categories"),
                      F.col("answered").alias("changed"))


@query(O.sql("""SELECT count(*) AS scanned, count(CASE WHEN list_sort(previous) <> list_sort(next) THEN 1 END) AS changed,
  count(CASE WHEN len(previous) > 0 AND len(next) = 0 THEN 1 END) AS cleared, cast(0 AS bigint) AS fallback FROM v""",
             "lead", v=_RECAT))
def recategorize_stats(spark, sf):
    return G.recategorize_stats(G.recategorize(W.lead(spark, sf), _NEWER))


@query(O.sql("SELECT type, count(*) AS n_events, count(lead_id) AS n_attached FROM audit GROUP BY type", "keyed", audit=_AUDIT))
def audit_rollup(spark, sf):
    return rollup(W.audit_events(spark, sf))


# -- whole jobs -----------------------------------------------------------------------------

# What survives the landing: a listing knows no registration number and no code,
# neither source states a brand or a flag, nameless records go, provenance is the source's.
_LANDED = f"""SELECT * REPLACE (
    CASE WHEN source = 'directory' THEN NULL ELSE registration_number END AS registration_number,
    CASE WHEN source = 'directory' THEN NULL ELSE activity_code END AS activity_code,
    cast(NULL AS boolean) AS is_personal_data, cast(NULL AS varchar) AS brand_name,
    CASE WHEN source = 'directory' THEN concat('https://directory.example/biz/', k)
         ELSE concat('https://companies.example/cegadat/', k) END AS source_url, trim(legal_name) AS legal_name)
  FROM ({S.raw_business_sql()}) z WHERE k % 29 <> 0"""

_JOB_COLUMNS = ["lead_id", *_MERGED_COLUMNS, "quality_score"]


def _job_sql(landed: str) -> str:
    return O.sql(f"""SELECT sha256(dedupe_key) AS lead_id, {', '.join(_MERGED_COLUMNS)}, {O.joined('categories')} AS categories,
      {O.score()} AS quality_score FROM merged""", "merged", raw=landed)


_JOB_SQL = _job_sql(_LANDED)


def _land(spark, sf) -> DataFrame:
    """Customers as registry pages, suppliers as directory pages."""
    parts = []
    for source, record in (("directory", F.to_json(F.struct(
            F.col("k").alias("id"), _named().alias("name"), "email", "phone", "website", "address",
            F.col("vat_number").alias("vat"), "activity"))), ("ebeszamolo", _register_record("companyName"))):
        pages = _page_rows(spark, sf, source, record).filter(F.col("region_id").startswith(source))
        parts.append(pages.withColumn("region_id", F.substring_index("region_id", "/", -1)))
    return parts[0].unionByName(parts[1]).withColumn("fetched_at", W.now())


def _stored(store: Store) -> DataFrame:
    return store.read("lead").withColumn("categories", joined("categories")).select(*_JOB_COLUMNS, "categories")


@query(_JOB_SQL)
def ingest(spark, sf):
    """Pages -> parse -> normalise -> collapse -> upsert, through a store."""
    root = scratch_dir(spark, "ingest")
    _land(spark, sf).write.parquet(f"{root}/pages")
    store = Store(spark, f"{root}/store")
    ingest_job(store, read_pages(spark, f"{root}/pages"), "run", datetime(1999, 6, 1), all_pages=True)
    return _stored(store)


_FEW_REGIONS = "zala, pest"
# Regions are taken in the order of the list: which record comes first depends on it.
_FEW_LANDED = f"""SELECT * REPLACE (CASE crawl_region WHEN 'zala' THEN 0 ELSE 1 END AS region_ord,
    seqno + (CASE crawl_region WHEN 'zala' THEN 0 ELSE 1 END - region_ord) * cast(1000000000 AS bigint) AS seqno)
  FROM ({_LANDED}) y WHERE crawl_region IN ('zala', 'pest')"""
_PERSONS = f"""SELECT * REPLACE ('evny' AS source, true AS is_personal_data,
    concat('https://soletraders.example/ev/', k) AS source_url,
    'sole-trader register, personal data' AS source_license) FROM ({_FEW_LANDED}) x WHERE source = 'ebeszamolo'"""


@query(f"""SELECT 'default' AS run, * FROM ({_job_sql(_FEW_LANDED)}) a
  UNION ALL SELECT 'persons' AS run, * FROM ({_job_sql(_PERSONS)}) b""")
def gated_ingest(spark, sf):
    """Runs over listed regions where a register of persons has landed too: it is read only where it is enabled."""
    root = scratch_dir(spark, "gated")
    landed = _land(spark, sf)
    persons = _page_rows(spark, sf, "evny", _register_record("name")).filter(F.col("region_id").startswith("ebeszamolo"))
    persons = persons.withColumn("region_id", F.substring_index("region_id", "/", -1)).withColumn("fetched_at", W.now())
    landed.unionByName(persons).write.parquet(f"{root}/pages")
    out = []
    for run, sources, enabled in (("default", None, set()), ("persons", ["evny"], {"evny"})):
        store = Store(spark, f"{root}/{run}")
        ingest_job(store, read_pages(spark, f"{root}/pages"), run, datetime(1999, 6, 1), sources=sources,
                   regions=P.region_expand(_FEW_REGIONS), enabled=enabled, all_pages=True)
        out.append(_stored(store).select(F.lit(run).alias("run"), "*"))
    return out[0].unionByName(out[1])


@query(_JOB_SQL)
def ingest_stream(spark, sf):
    """The same result by Structured Streaming over the landing folder."""
    root = scratch_dir(spark, "ingest-stream")
    _land(spark, sf).write.parquet(f"{root}/pages")
    stream = run_stream(spark, f"{root}/pages", f"{root}/store", f"{root}/checkpoint", now=datetime(1999, 6, 1))
    stream.awaitTermination()
    return _stored(Store(spark, f"{root}/store"))


# A crawl with gaps, saved cursors, one page that is not JSON, and a limit of records per region.
_GAP, _BAD, _LIMIT = "(source = 'ebeszamolo' AND page % 11 = 6)", "(source = 'ebeszamolo' AND {0} = 'pest' AND page = 3)", 60
_START = "CASE WHEN source <> 'ebeszamolo' THEN 1 WHEN crawl_region = 'vas' THEN 2 WHEN crawl_region = 'zala' THEN 8 ELSE 1 END"
_PAGES = f"""SELECT source, crawl_region, page, {_START} AS start_page,
    count(CASE WHEN k % 29 <> 0 AND NOT {_BAD.format('crawl_region')} THEN 1 END) AS n_rows
  FROM ({S.raw_business_sql()}) z WHERE NOT {_GAP} GROUP BY source, crawl_region, page"""
_REACHED = f"""SELECT source, crawl_region, start_page, start_page - 1 + count(CASE WHEN page - rn = start_page - 1 THEN 1 END) AS last_page
  FROM (SELECT p.*, CASE WHEN n_rows > 0 AND page >= start_page THEN
    row_number() OVER (PARTITION BY source, crawl_region, n_rows > 0 AND page >= start_page ORDER BY page) END AS rn FROM ({_PAGES}) p) q
  GROUP BY source, crawl_region, start_page"""
_FAILED = f"""EXISTS (SELECT 1 FROM ({_PAGES}) b WHERE b.source = r.source AND b.crawl_region = r.crawl_region
  AND {_BAD.format('b.crawl_region').replace('source', 'b.source').replace('page', 'b.page')} AND b.page = r.last_page + 1)"""
_CHOSEN = f"""SELECT * EXCLUDE (nth) FROM (SELECT z.*, row_number() OVER (PARTITION BY z.source, z.crawl_region ORDER BY z.page, z.pos, z.k) AS nth
  FROM ({_LANDED}) z JOIN ({_REACHED}) r ON r.source = z.source AND r.crawl_region = z.crawl_region
   AND z.page BETWEEN r.start_page AND r.last_page AND NOT {_FAILED}) y WHERE nth <= {_LIMIT}"""


@query(O.sql(f"""SELECT (SELECT count(*) FROM flagged) AS fetched, (SELECT count(*) FROM m) AS created,
  (SELECT count(CASE WHEN NOT suppressed THEN 1 END) FROM flagged) - (SELECT count(*) FROM m) AS merged,
  (SELECT count(CASE WHEN suppressed THEN 1 END) FROM flagged) AS skipped,
  (SELECT string_agg(source || '/' || crawl_region || '/' || (last_page + 1), ',') FROM ({_REACHED}) r WHERE {_FAILED}) AS failed,
  count(CASE WHEN valid THEN 1 END) AS verified, count(CASE WHEN taxed THEN 1 END) AS nav_checked,
  count(CASE WHEN met AND (d.email IS NULL OR d.phone IS NULL) THEN 1 END) AS contacts_enriched,
  count(CASE WHEN (phone2 IS NULL AND p.phone IS NOT NULL) OR (d.website IS NULL AND p.website IS NOT NULL)
    OR (address2 IS NULL AND p.address IS NOT NULL) THEN 1 END) AS places_enriched,
  count(CASE WHEN is_personal_data THEN 1 END) AS purged, count(CASE WHEN NOT is_personal_data THEN 1 END) AS left_over
  FROM placed d LEFT JOIN (SELECT name, phone, website, address FROM places) p ON p.name = d.place""",
             "flagged", "vat_register", "tax_signals", "contacts", "places", raw=_CHOSEN,
             clean="SELECT * FROM flagged WHERE NOT suppressed", m=O.merged("clean"),
             looked=f"""SELECT m.*, coalesce(v.valid, false) AS valid, t.core IS NOT NULL AS taxed, c.domain IS NOT NULL AS met,
               coalesce(m.phone, c.phone) AS phone2, coalesce(m.address, CASE WHEN v.valid THEN v.address END) AS address2
               FROM m LEFT JOIN vat_register v ON v.core = {O.vat_core('m.vat_number')} LEFT JOIN tax_signals t ON t.core = {O.vat_core('m.vat_number')}
               LEFT JOIN contacts c ON c.domain = m.domain AND (m.email IS NULL OR m.phone IS NULL)""",
             placed=f"""SELECT l.*, coalesce(a.name, b.name) AS place FROM looked l
               LEFT JOIN places a ON a.name = l.legal_name AND (l.phone2 IS NULL OR l.website IS NULL)
               LEFT JOIN places b ON b.name = {O.company_name('l.legal_name')} AND (l.phone2 IS NULL OR l.website IS NULL)"""))
def refresh(spark, sf):
    """A whole cycle over a store: ingest with cursors, gaps, a bad page, a limit and suppressions, four lookups, purge."""
    root, now = scratch_dir(spark, "refresh"), datetime(1999, 6, 1)
    source, region, page = F.col("source"), F.col("region_id"), F.col("page")
    body = F.when(F.expr(_BAD.format("region_id")), F.lit('{"results": [')).otherwise(F.col("body"))
    _land(spark, sf).filter(~F.expr(_GAP)).withColumn("body", body).write.parquet(f"{root}/pages")
    store = Store(spark, f"{root}/store")
    store.append("suppression", S.suppression(spark, sf), "seed")
    store.append("crawl_state", spark.createDataFrame(
        [("ebeszamolo", "vas", 2, 9, now), ("ebeszamolo", "zala", 8, 9, now)],
        "source string, region_id string, last_page int, total_seen bigint, last_run_at timestamp"), "seed")
    lookups = J.Lookups(W.vat_register(spark, sf), W.tax_signals(spark, sf), W.contacts(spark, sf), W.places(spark, sf))
    got = J.refresh(store, read_pages(spark, f"{root}/pages"), lookups, "run", now, limit=_LIMIT)
    gone = J.purge(store, "purge", now + timedelta(days=365))
    stats, i = got, got.ingest
    failed = ",".join("/".join(map(str, page)) for page in i.bad_pages) or None
    row = (i.fetched, i.created, i.merged, i.skipped_suppressed, failed, stats.verified, stats.nav_checked, stats.contacts_enriched,
           stats.places_enriched, gone["suppressed"] + gone["expired"])
    counts = spark.createDataFrame([row], """fetched bigint, created bigint, merged bigint, skipped bigint, failed string, verified bigint,
      nav_checked bigint, contacts_enriched bigint, places_enriched bigint, purged bigint""")
    return counts.join(store.read("lead").agg(F.count(F.lit(1)).alias("left_over")), F.lit(True))


@query(O.sql("""SELECT row_number() OVER (ORDER BY quality_score DESC, lead_id) AS line, lead_id AS "externalId", quality_score AS "qualityScore",
  13 AS n_fields, (vat_number IS NULL)::INT + (registration_number IS NULL)::INT + (region_id IS NULL)::INT + (email IS NULL)::INT
  + (phone IS NULL)::INT + (website IS NULL)::INT + (tax_status IS NULL)::INT + (debt_free IS NULL)::INT AS n_nulls
  FROM lead WHERE quality_score >= 40 AND review_status <> 'REJECTED' AND NOT is_personal_data""", "lead"))
def export_ndjson(spark, sf):
    """The export as its files hold it: order of lines, explicit nulls."""
    path = scratch_dir(spark, "export")
    X.export_ndjson(W.lead(spark, sf), path, min_quality=40)
    fields = F.from_json("record", ", ".join(f"{n} string" for n in X.EXPORT_FIELDS))
    rows = X.read_ndjson(spark, path).select("line", fields.alias("f"), F.size(F.json_object_keys("record")).alias("n_fields"))
    nulls = [F.col(f"f.{n}").isNull().cast("int") for n in X.EXPORT_FIELDS]
    return rows.select("line", "f.externalId", F.col("f.qualityScore").cast("int").alias("qualityScore"), "n_fields",
                       sum(nulls[1:], nulls[0]).alias("n_nulls"))


@query(O.sql(f"""SELECT row_number() OVER (ORDER BY l.lead_id, a.created_at, a.event_id) AS line, email AS subject, l.lead_id, type,
  {O.iso('a.created_at')} AS created_at, count(*) OVER (PARTITION BY l.lead_id) AS trail_events,
  count(*) FILTER (WHERE false) OVER () AS n_missing FROM lead l JOIN audit a ON a.lead_id = l.lead_id WHERE email IS NOT NULL""", "lead", audit=_AUDIT))
def write_dsar_report(spark, sf):
    """The access report of all subjects, read back from its files: the trail's lines with their records."""
    path, lead = scratch_dir(spark, "dsar"), W.stored_lead(spark, sf)
    report = G.dsar_export(lead, W.audit_events(spark, sf), lead.filter("email is not null").select("email"))
    G.write_dsar_report(report, path, W.now())
    trail = X.read_ndjson(spark, f"{path}/trail").select("line", F.from_json(
        "record", "subject string, lead_id string, type string, created_at string").alias("e")).select("line", "e.*")
    records = spark.read.schema("lead_id string, subject string, trail_events bigint").json(f"{path}/records")
    subjects = spark.read.schema("subject string, lead_count bigint").json(f"{path}/subjects")
    counted = records.groupBy("subject").agg(F.count(F.lit(1)).alias("n")).join(subjects, "subject", "full")
    missing = counted.agg(F.count_if(~F.coalesce(F.col("n") == F.col("lead_count"), F.lit(False))).alias("n_missing"))
    return trail.join(records.drop("subject"), "lead_id", "left").join(missing, F.lit(True))


@query(O.sql("""SELECT type AS kind, count(*) AS n FROM audit a WHERE a.lead_id IS NULL
    OR a.lead_id NOT IN (SELECT lead_id FROM v WHERE reason IS NOT NULL) GROUP BY type
  UNION ALL SELECT 'PURGED', count(*) FROM v WHERE reason IS NOT NULL HAVING count(*) > 0
  UNION ALL SELECT 'leads', count(*) FROM v WHERE reason IS NULL""", "lead", "sup", audit=_AUDIT, v=_DECIDED))
def purge(spark, sf):
    """The purge as a job over a store: what it leaves of records and events."""
    store = Store(spark, scratch_dir(spark, "purge"))
    lead = W.stored_lead(spark, sf)
    store.change_lead(lead, lambda _: lead, "seed")
    store.append("audit_event", W.audit_events(spark, sf), "seed")
    store.append("suppression", S.suppression(spark, sf), "seed")
    J.purge(store, "run", datetime(1999, 6, 1, 12))
    events = store.read("audit_event").groupBy(F.col("type").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return events.unionByName(store.read("lead").agg(F.count(F.lit(1)).alias("n")).select(F.lit("leads").alias("kind"), "n"))


@query(O.sql("""SELECT type, count(*) AS n_events, count(CASE WHEN late OR lead_id IS NULL OR lead_id >= '4' THEN 1 END) AS n_held
  FROM (SELECT a.*, cast(event_id AS bigint) % 5 = 0 AS late FROM audit a) e GROUP BY type""", "keyed", audit=_AUDIT))
def audit_stream(spark, sf):
    """Events counted by a stream: some are appended, some leads are erased, more events are
    appended, and the stream goes on from its checkpoint. Beside it what the store holds then."""
    root = scratch_dir(spark, "audit-stream")
    store = Store(spark, f"{root}/store")
    events = W.audit_events(spark, sf).withColumn("late", F.col("event_id").cast("bigint") % 5 == 0)

    def follow() -> None:
        counted = stream_counts(spark, f"{root}/store/audit_event").writeStream.outputMode("complete").foreachBatch(
            lambda counts, _: counts.write.mode("overwrite").parquet(f"{root}/counts"))
        counted.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    for run in range(3):
        mine = F.pmod(F.xxhash64("event_id"), F.lit(3)) == run
        store.append("audit_event", events.filter(~F.col("late") & mine).drop("late"), f"run-{run}")
    follow()
    doomed = store.read("audit_event").filter("lead_id < '4'").select("lead_id").distinct()
    doomed.write.parquet(f"{root}/doomed")
    doomed = spark.read.parquet(f"{root}/doomed")
    touched = store.read("audit_event").join(doomed, "lead_id", "left_semi")
    store.erase_events(lambda held: G.erase_events(held, doomed), touched, "erasure")
    store.append("audit_event", events.filter("late").drop("late"), "later")
    follow()
    held = store.read("audit_event").groupBy("type").agg(F.count(F.lit(1)).alias("n_held"))
    return spark.read.parquet(f"{root}/counts").join(held, "type", "left").withColumn("n_held", F.coalesce("n_held", F.lit(0)))


@query(O.sql("""SELECT l.lead_id, l.type, l.meta FROM (
    SELECT sha256(m2.dedupe_key) AS lead_id, 'MERGED' AS type,
           concat('{"source":"directory","count":', m2.input_count, '}') AS meta
    FROM m2 JOIN m1 ON m1.dedupe_key = m2.dedupe_key
    UNION ALL
    SELECT sha256(m2.dedupe_key), 'COLLECTED', concat('{"source":"', m2.source, '","sourceUrl":"', m2.source_url,
           '","license":"', m2.source_license, '"}')
    FROM m2 WHERE m2.dedupe_key NOT IN (SELECT dedupe_key FROM m1)) l""", "keyed", **_TWO))
def append_audit(spark, sf):
    """Events of a second batch over a stored first one."""
    lead, second = _two_batches(spark, sf)
    matched = M.match_existing(second, lead).withColumn("lead_id", M.lead_id_of(F.col("dedupe_key")))
    rows = W.batch(spark, sf).filter("source = 'directory'").withColumn("suppressed", F.lit(False))
    return ingest_events(rows, matched, W.now(), "run").select("lead_id", "type", "meta")
