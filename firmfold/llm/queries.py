"""One registered query per training-data operator, with SQL where SQL can say it."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmfold.llm import (embed_dedup, filter_audit, jaccard, language, license_scan, mixing, neighbours, packing, quality,
                          toxicity, url_filter, warc, whitening)
from firmfold.llm.common import configure, table
from firmfold.llm.mixing_sql import MIX_SQL
from firmfold.llm.sql import AUDIT_SQL, JACCARD_SQL, QUALITY_SQL, WARC_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query(QUALITY_SQL)
def op3_quality_rules(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.withColumn("failed", F.array_join("failed", ","))


@query(MIX_SQL)
def op9_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query(JACCARD_SQL)
def op4_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("handle", "stays")


@query()
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


@query()
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.judge(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query()
def op6_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumn("spans", F.to_json("spans"))


@query()
def op8_embedding_dedup(spark, sf_dir):
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op11_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(neighbours.build(vectors), vectors.filter("vec_id % 20 = 0"))


@query()
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query(AUDIT_SQL)
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(WARC_SQL)
def op1_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def _hex(text, first, digits):
    return F.conv(F.substring(F.md5(text.cast("binary")), first, digits), 16, 10).cast("bigint")


def _captures(spark, sf_dir):
    """The pages, each with a fetch time within a year that its id gives."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(525600)) * 60)
    return table(spark, sf_dir, "pages").select("page_id", "url", at.alias("fetched_at"))


def _list_entries(captures):
    """A dated list: none to three entries for each pattern that a page's URL has, by its hash."""
    patterns = captures.select(F.explode(url_filter.patterns_of(F.col("url"))).alias("pattern")).distinct()
    pattern = F.col("pattern")
    each = patterns.filter(_hex(pattern, 1, 1) % 4 > 0).withColumn(
        "nth", F.explode(F.sequence(F.lit(1).cast("bigint"), _hex(pattern, 1, 1) % 4)))
    seed = F.concat_ws("#", pattern, F.col("nth").cast("string"))
    at = F.timestamp_seconds(F.lit(1704067200) + _hex(seed, 1, 8) % 525600 * 60)
    action = F.get(F.array(*map(F.lit, url_filter.ACTIONS)), (_hex(seed, 9, 4) % 3).cast("int"))
    return each.select("pattern", action.alias("action"), at.alias("effective_at"))


_URL_SQL = r"""WITH
capture AS (SELECT page_id, url, 1704067200 + (page_id * 7919 % 525600) * 60 AS at_s,
  regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)), '\.+$', '') AS host,
  list_filter(string_split(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS seg FROM pages),
parts AS (SELECT *, string_split(host, '.') AS lab FROM capture WHERE host <> ''),
chain AS (
  SELECT page_id, url, at_s, k AS rank, array_to_string(lab[len(lab) - k + 1:len(lab)], '.') AS pattern
  FROM parts, LATERAL (SELECT unnest(range(1, len(lab) + 1)) AS k)
  UNION ALL
  SELECT page_id, url, at_s, len(lab) + k, lower(host || '/' || array_to_string(seg[1:k], '/'))
  FROM parts, LATERAL (SELECT unnest(range(1, len(seg) + 1)) AS k)),
pattern AS (SELECT DISTINCT pattern AS shown FROM (
  SELECT array_to_string(lab[len(lab) - k + 1:len(lab)], '.') AS pattern FROM parts, LATERAL (SELECT unnest(range(1, len(lab) + 1)) AS k)
  UNION ALL SELECT host || '/' || array_to_string(seg[1:k], '/') FROM parts, LATERAL (SELECT unnest(range(1, len(seg) + 1)) AS k))),
entry AS (SELECT lower(shown) AS pattern, shown || '#' || nth AS seed FROM pattern,
  LATERAL (SELECT unnest(range(1, ('0x' || md5(shown)[1:1])::BIGINT % 4 + 1)) AS nth)),
dated AS (SELECT pattern, 1704067200 + (('0x' || md5(seed)[1:8])::BIGINT % 525600) * 60 AS since,
  min(('0x' || md5(seed)[9:12])::BIGINT % 3) AS action FROM entry GROUP BY 1, 2),
active AS (SELECT pattern, since, ['block', 'allow', 'drop'][action + 1] AS action,
  lead(since) OVER (PARTITION BY pattern ORDER BY since) AS until FROM dated),
met AS (SELECT c.page_id, c.url, c.at_s, c.rank, a.pattern, a.action, a.since FROM chain c JOIN active a
  ON a.pattern = c.pattern AND a.since <= c.at_s AND (a.until IS NULL OR c.at_s < a.until) AND a.action <> 'drop'),
best AS (SELECT page_id, count(*) AS n_active, arg_max(pattern, rank) AS pattern, arg_max(action, rank) AS action,
  arg_max(since, rank) AS since FROM met GROUP BY page_id)
SELECT p.page_id, p.url, coalesce(b.n_active, 0) AS n_active, b.pattern, b.action, b.since,
  coalesce(b.action = 'allow', true) AS kept FROM pages p LEFT JOIN best b ON b.page_id = p.page_id"""


@query(_URL_SQL)
def op2_url_filters(spark, sf_dir):
    captures = _captures(spark, sf_dir)
    judged = url_filter.judge(captures, _list_entries(captures))
    return judged.withColumn("since", F.unix_seconds("since")).drop("fetched_at")
