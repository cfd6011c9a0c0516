"""Staged frames that several registered queries start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmfold.functions.classify import activity_to_categories
from firmfold.functions.score import score_of_row
from firmfold.operators.consolidate import as_lead, dedupe_batch, lead_id_of
from firmfold.operators.normalize import normalize_businesses, region_fallback, with_dedupe_key
from firmfold.schemas import LEAD, LEAD_COLUMNS
from firmfold.session import scratch_dir
from firmfold.sources.contact_pages import merge_contact_pages
from firmfold.sources.lookups import parse_places, parse_tax_signals, parse_vat_register
from firmfold.suite import staging as S


def now() -> Column:
    return F.lit("1999-06-01 12:00:00").cast("timestamp")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw business records, code categories included."""
    return S.raw_business(spark, sf).withColumn(
        "categories", activity_to_categories(F.array("activity_code")))


def normalised(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_businesses(raw(spark, sf))


def batch(spark: SparkSession, sf: str) -> DataFrame:
    return with_dedupe_key(region_fallback(normalised(spark, sf)))


def merged(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_batch(batch(spark, sf), seq="seqno")


def lead(spark: SparkSession, sf: str) -> DataFrame:
    """The master table as a plan: only what a query reads of it is derived."""
    return _lead(spark, sf)


def stored_lead(spark: SparkSession, sf: str) -> DataFrame:
    """The same as the jobs have it: written, once per query call, then read."""
    path = scratch_dir(spark, "lead")
    _lead(spark, sf).write.parquet(path)
    return spark.read.schema(LEAD).parquet(path)


def _lead(spark: SparkSession, sf: str) -> DataFrame:
    """A master table with history: dates from orders, decisions from labels."""
    k = (F.expr("cast(floor(first_seq / 100) as bigint)") % 10000000 - 1) * 40 + F.col("first_seq") % 100
    orders = S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("timestamp").alias("at"))
    labels = S.table(spark, sf, "labels").select(F.col("doc_id").alias("k"), "quality")
    rows = merged(spark, sf).withColumn("k", k).join(orders, "k", "left").join(labels, "k", "left")

    def at(n: int):
        return F.when(F.col("k") % n == 0, F.col("at"))

    checked = F.col("k") % 17 == 0
    filled = rows.withColumns({
        "lead_id": lead_id_of(F.col("dedupe_key")), "quality_score": score_of_row(),
        "gdpr_basis": F.lit("legitimate_interest"),
        "lifecycle": F.when(F.col("k") % 4 == 1, "CONTACTED").otherwise("NEW"),
        "review_status": F.when(F.col("quality") == 1, "APPROVED")
        .when(F.col("quality") == 0, "REJECTED").otherwise("PENDING"),
        "collected_at": F.col("at"), "last_verified_at": at(13), "nav_checked_at": at(17),
        "contact_checked_at": at(19), "places_checked_at": at(23),
        "tax_status": F.when(checked, F.when(F.col("k") % 2 == 0, "ACTIVE").otherwise("CANCELLED")),
        "debt_free": F.when(checked, F.col("k") % 3 == 0)})
    types = dict(part.split() for part in LEAD.split(","))
    missing = {n: F.lit(None).cast(types[n]) for n in LEAD_COLUMNS if n not in filled.columns}
    return as_lead(filled.withColumns(missing))


def _answers(spark: SparkSession, sf: str, key: str, body: str) -> DataFrame:
    """Each answer, and an older, longer-sorting copy that must not count."""
    copies = F.array(
        F.struct(F.col(body).alias("body"), F.lit("2024-01-01").cast("timestamp").alias("fetched_at")),
        F.struct(F.lit('{"z":0,"valid":true,"taxStatus":"ACTIVE","phone":"1"}').alias("body"),
                 F.lit("2020-01-01").cast("timestamp").alias("fetched_at")))
    return S.lookups(spark, sf).select(F.col(key).alias("key"), F.explode(copies).alias("c")).select("key", "c.*")


def vat_register(spark: SparkSession, sf: str) -> DataFrame:
    return parse_vat_register(_answers(spark, sf, "core", "vat_body"))


def tax_signals(spark: SparkSession, sf: str) -> DataFrame:
    return parse_tax_signals(_answers(spark, sf, "core", "tax_body"))


def places(spark: SparkSession, sf: str) -> DataFrame:
    return parse_places(_answers(spark, sf, "place_name", "place_body"))


def contact_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Three pages per site, as rows (domain, path, body, fetched_at)."""
    page = F.array(F.struct(F.lit("").alias("path"), F.col("home_body").alias("body")),
                   F.struct(F.lit("/kapcsolat").alias("path"), F.col("contact_body").alias("body")),
                   F.struct(F.lit("/impresszum").alias("path"), F.col("imprint_body").alias("body")))
    return S.lookups(spark, sf).select("domain", F.explode(page).alias("p")).select(
        "domain", "p.path", "p.body", F.lit("2024-01-01").cast("timestamp").alias("fetched_at"))


def contacts(spark: SparkSession, sf: str) -> DataFrame:
    return merge_contact_pages(contact_pages(spark, sf))


def audit_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as an audit table: the user's number picks the customer record
    whose identity the event belongs to; sign-ups are detached."""
    events = S.table(spark, sf, "events")
    owners = batch(spark, sf).filter("source = 'ebeszamolo'").select(
        F.col("k").alias("user_id"), lead_id_of(F.col("dedupe_key")).alias("owner"))
    return events.join(owners, "user_id", "left").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") != "signup", F.col("owner")).alias("lead_id"),
        F.upper("event_type").alias("type"), F.col("props").alias("meta"),
        F.col("ts").cast("timestamp").alias("created_at"), F.lit("history").alias("run_id"))
