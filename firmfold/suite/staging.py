"""The driver's tables as business records.

The tables hold no business records, so these projections derive them, row by
row, from customers and suppliers: same text for Spark and for the SQL that
checks it. Identities are shared on purpose: every fourth customer repeats its
neighbour, every supplier repeats a customer, one site and one name are shared
by a large part of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

PAGE_ROWS = 40


def at(sf: str, name: str) -> str:
    """A table as a name for Spark's FROM clause."""
    return f"parquet.`{sf}/{name}.parquet`"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# SQL common to both engines; {customer} and {supplier} name the tables.
_BASE = """
SELECT 'ebeszamolo' AS source, 3 AS source_ord, c_custkey AS k,
       CASE WHEN c_custkey % 4 = 3 THEN c_custkey - 1 ELSE c_custkey END AS e, c_nationkey AS nk
FROM {customer}
UNION ALL
SELECT 'directory' AS source, 1 AS source_ord, s_suppkey AS k, s_suppkey * 4 AS e, s_nationkey AS nk
FROM {supplier}
"""

_DIGITS = """
SELECT b.*, cast(k AS varchar(20)) AS ks, cast(e AS varchar(20)) AS es,
       cast(1000000 + (e * 7919) % 9000000 AS varchar(20)) AS b7,
       cast(floor(k / 40) AS int) + 1 AS page, cast(k % 40 AS int) AS pos,
       CASE nk % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 17 ELSE 19 END AS region_ord,
       CASE nk % 5 WHEN 0 THEN 'budapest' WHEN 1 THEN 'pest' WHEN 2 THEN 'baranya' WHEN 3 THEN 'vas'
                   ELSE 'zala' END AS crawl_region
FROM ({base}) b
"""

_CHECK = " + ".join(f"cast(substr(b7, {i + 1}, 1) AS int) * {w}" for i, w in
                    enumerate([9, 7, 3, 1, 9, 7, 3]))

_CHECKED = f"SELECT d.*, (10 - ({_CHECK}) % 10) % 10 AS chk FROM ({{digits}}) d"

_RAW = """
SELECT source, source_ord, region_ord, crawl_region, page, pos, k, e,
  cast(source_ord AS bigint) * 100000000000 + cast(region_ord AS bigint) * 1000000000
    + cast(page AS bigint) * 100 + pos AS seqno,
  CASE k % 6 WHEN 0 THEN concat('Ceg ', es, ' Kft.') WHEN 1 THEN concat('CEG ', es, ' KFT')
             WHEN 2 THEN concat('Nagy Péter ', es, ' e.v.')
             WHEN 3 THEN concat('Árvíz & Társa ', es, ' Zrt.')
             WHEN 4 THEN concat('  Minta Bt. ', cast(e % 20 AS varchar(20)), ' ')
             ELSE 'Közös Név Kft.' END AS legal_name,
  CASE WHEN k % 10 = 3 THEN concat(' Márka ', ks) WHEN k % 10 = 4 THEN ' ' END AS brand_name,
  CASE k % 7 WHEN 0 THEN concat(' Info@Ceg', es, '.HU ') WHEN 1 THEN concat('kovacs.janos@ceg', es, '.hu')
             WHEN 3 THEN 'nincs' WHEN 4 THEN concat('iroda', ks, '@kozos.hu')
             WHEN 5 THEN concat('a b@ceg', es, '.hu')
             WHEN 6 THEN concat('nagy_pal@minta', cast(k % 50 AS varchar(20)), '.hu') END AS email,
  CASE k % 6 WHEN 0 THEN concat('06 30 ', lpad(cast(k % 10000000 AS varchar(20)), 7, '0'))
             WHEN 1 THEN concat('+36 (1) ', lpad(cast(k % 10000000 AS varchar(20)), 7, '0'))
             WHEN 2 THEN concat('0036-20/', lpad(cast(k % 10000000 AS varchar(20)), 7, '0'))
             WHEN 3 THEN '123'
             WHEN 5 THEN concat('36', lpad(cast(k % 10000000 AS varchar(20)), 9, '0')) END AS phone,
  CASE k % 9 WHEN 0 THEN concat('https://www.ceg', es, '.hu/kapcsolat?x=1')
             WHEN 1 THEN concat('CEG', es, '.HU') WHEN 3 THEN 'localhost' WHEN 4 THEN 'www.kozos.hu'
             WHEN 5 THEN concat('http://user:pw@ceg', es, '.hu:8080/a')
             WHEN 6 THEN concat('ceg ', es, '.hu') WHEN 7 THEN ' http://kozos.hu '
             WHEN 8 THEN '  ' END AS website,
  CASE e % 10 WHEN 0 THEN '1051 Budapest, Fő utca 1' WHEN 1 THEN '8900 Zalaegerszeg, Kossuth u. 2'
              WHEN 2 THEN '7621 Pécs, Széchenyi tér 3' WHEN 3 THEN '9021 GYŐR'
              WHEN 4 THEN ' 2100 Gödöllő' WHEN 5 THEN concat('NATION_', cast(nk AS varchar(20)))
              WHEN 7 THEN 'Budapest, Pest' WHEN 8 THEN '4024 Debrecen, Piac utca 1234'
              WHEN 9 THEN ' ' END AS address,
  CASE e % 5 WHEN 0 THEN concat(b7, cast(chk AS varchar(20)), CASE WHEN source = 'directory' THEN '-1-42' ELSE '' END)
             WHEN 1 THEN concat(' HU', b7, cast(chk AS varchar(20)), '-2-41')
             WHEN 2 THEN concat(b7, cast((chk + 1) % 10 AS varchar(20))) WHEN 3 THEN ' ' END AS vat_number,
  CASE e % 4 WHEN 0 THEN concat('01-09-', lpad(cast(e % 1000000 AS varchar(20)), 6, '0'))
             WHEN 1 THEN concat('01 09 ', lpad(cast(e % 1000000 AS varchar(20)), 6, '0'))
             WHEN 2 THEN '12345678' END AS registration_number,
  CASE e % 8 WHEN 0 THEN 'Irodatakarítás és tisztítás' WHEN 1 THEN 'KLÍMA szerelés, fűtés'
             WHEN 2 THEN 'IT support' WHEN 3 THEN 'Margit nonprofit pékség'
             WHEN 4 THEN 'security guard, őrzés-védelem' WHEN 5 THEN 'Tűzjelző rendszerek'
             WHEN 7 THEN 'munkavédelem, air condition' END AS activity,
  CASE k % 7 WHEN 0 THEN '8121' WHEN 1 THEN '81.22' WHEN 2 THEN '4322' WHEN 3 THEN '8010'
             WHEN 4 THEN '9999' WHEN 6 THEN '6201' END AS activity_code,
  CASE WHEN k % 11 = 0 THEN true END AS is_personal_data,
  concat('https://example.org/', source, '/', ks) AS source_url,
  CASE WHEN source = 'directory' THEN 'open directory data' ELSE 'public company data' END AS source_license,
  concat(b7, cast(chk AS varchar(20))) AS core
FROM ({checked}) c
"""


# A million of these rows fit a file of few megabytes, which few tasks would read: Spark deals the
# slim rows out before any text is made of them.
_SPREAD = "SELECT /*+ REPARTITION({n}, source, k, nk) */ * FROM ({base}) s"


def raw_business_sql(customer: str = "customer", supplier: str = "supplier", base: str = _BASE) -> str:
    base = base.format(customer=customer, supplier=supplier)
    return _RAW.format(checked=_CHECKED.format(digits=_DIGITS.format(base=base)))


def raw_business(spark: SparkSession, sf: str) -> DataFrame:
    """The staged records; ``classification_text`` as a parser composes it."""
    spread = _SPREAD.format(n=spark.conf.get("spark.sql.shuffle.partitions"), base=_BASE)
    rows = spark.sql(raw_business_sql(at(sf, "customer"), at(sf, "supplier"), spread))
    text = F.concat_ws(" ", F.coalesce("activity", F.lit("")), F.trim("legal_name"))
    return rows.withColumn("classification_text", F.trim(text))


# The list of suppressed values, from suppliers: sites, addresses, one provider.
SUPPRESSION_SQL = """
SELECT concat('ceg', cast(s_suppkey * 4 AS varchar(20)), '.hu') AS value, 'DOMAIN' AS kind, 'opt-out' AS reason
FROM {supplier} WHERE s_suppkey % 5 = 1
UNION ALL
SELECT concat('iroda', cast(s_suppkey * 7 + 4 AS varchar(20)), '@kozos.hu') AS value, 'EMAIL' AS kind, 'bounce' AS reason
FROM {supplier} WHERE s_suppkey % 5 = 2
UNION ALL
SELECT concat('minta', cast(s_suppkey AS varchar(20)), '.hu') AS value, 'DOMAIN' AS kind, 'opt-out' AS reason
FROM {supplier} WHERE s_suppkey < 50 AND s_suppkey % 5 = 3
"""


def suppression(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(SUPPRESSION_SQL.format(supplier=at(sf, "supplier"))).withColumn(
        "created_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))


# Orders as landed pages: one page per (source, region, page number), its rows
# being the orders that fall on it; some pages are missing, some are empty.
CRAWL_PAGES_SQL = """
SELECT concat('source', cast(o_custkey % 3 AS varchar(20))) AS source,
       concat('region', lpad(cast(o_custkey % 20 AS varchar(20)), 2, '0')) AS region_id,
       cast(1 + floor(o_orderkey / 60) % 40 AS int) AS page,
       count(CASE WHEN o_orderkey % 3 <> 0 OR o_custkey % 2 = 0 THEN 1 END) AS n_rows
FROM {orders}
WHERE o_custkey % 60 <> floor(o_orderkey / 60) % 40
GROUP BY 1, 2, 3
"""

# Cursors saved by an earlier run, for two thirds of the regions.
CURSORS_SQL = """
SELECT source, region_id, cast(CASE WHEN max(page) % 4 = 0 THEN 0 ELSE min(page) + 1 END AS int) AS last_page,
       cast(count(*) AS bigint) AS total_seen
FROM ({pages}) p
WHERE source <> 'source2'
GROUP BY source, region_id
"""


def crawl_pages(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(CRAWL_PAGES_SQL.format(orders=at(sf, "orders"))).withColumn("malformed", F.lit(False))


def cursors(spark: SparkSession, sf: str) -> DataFrame:
    pages = CRAWL_PAGES_SQL.format(orders=at(sf, "orders"))
    return spark.sql(CURSORS_SQL.format(pages=pages)).withColumn(
        "last_run_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))


# Answers of the lookup services as JSON text, one per identity with a valid tax number.
_IDENTITIES = """
SELECT DISTINCT e, core, concat('ceg', cast(e AS varchar(20)), '.hu') AS domain FROM ({raw}) r
WHERE e % 5 IN (0, 1)
"""

LOOKUPS_SQL = """
SELECT e, core, domain,
  concat('{{"valid":', CASE e % 3 WHEN 0 THEN 'false' WHEN 1 THEN 'true' ELSE '"true"' END,
         ',"name":"---","address":"', CASE WHEN e % 4 = 0 THEN '---'
         ELSE concat(' Fő   utca ', cast(e AS varchar(20)), ' ') END, '"}}') AS vat_body,
  concat('{{"taxStatus":"', CASE e % 4 WHEN 0 THEN ' active ' WHEN 1 THEN 'SUSPENDED' WHEN 2 THEN 'cancelled'
         ELSE 'other' END, '","debtFree":', CASE e % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE '"true"' END,
         CASE e % 6 WHEN 0 THEN ',"employeeCount":12' WHEN 1 THEN ',"employeeCount":"7.9"'
                    WHEN 2 THEN ',"employeeCount":null' WHEN 3 THEN ',"employeeCount":-3' ELSE '' END,
         '}}') AS tax_body,
  concat('<html><b>Tel.: 06 70 ', lpad(cast(e % 10000000 AS varchar(20)), 7, '0'), '</b></html>') AS home_body,
  concat('<p>Kapcsolat:<i>Hello@Ceg', cast(e AS varchar(20)), '.HU</i>, iroda@ceg', cast(e AS varchar(20)),
         '.hu &lt;x&gt;</p>') AS contact_body,
  concat('<p>late@ceg', cast(e AS varchar(20)), '.hu</p>') AS imprint_body,
  CASE WHEN e % 2 = 0 THEN concat('Ceg ', cast(e AS varchar(20)), ' Kft.')
       ELSE concat('ceg ', cast(e AS varchar(20))) END AS place_name,
  concat('{{"formatted_phone_number":" +36 1 555 ', cast(e % 10000 AS varchar(20)), ' ","websiteUri":"https://hely',
         cast(e AS varchar(20)), '.hu/x","formatted_address":"', CASE WHEN e % 3 = 0 THEN ' ' ELSE 'Hely tér 1' END,
         '"}}') AS place_body
FROM ({identities}) i
"""


def lookups_sql(customer: str = "customer", supplier: str = "supplier") -> str:
    raw = raw_business_sql(customer, supplier)
    return LOOKUPS_SQL.format(identities=_IDENTITIES.format(raw=raw))


def lookups(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(lookups_sql(at(sf, "customer"), at(sf, "supplier")))
