"""Read side: counts and coverage, each one pre-aggregated pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmfold.functions.rules import DEFAULT_RULES, RuleSet


def _n(condition: str, name: str) -> Column:
    return F.count_if(F.expr(condition)).alias(name)


def coverage_report(lead: DataFrame) -> DataFrame:
    """Totals, review split (anything else is pending), enrichment, quality."""
    return lead.agg(
        F.count(F.lit(1)).alias("total"),
        _n("email is not null and email <> ''", "with_email"),
        _n("is_personal_data", "personal_data"),
        _n("coalesce(review_status, '') not in ('APPROVED', 'REJECTED')", "pending"),
        _n("review_status = 'APPROVED'", "approved"),
        _n("review_status = 'REJECTED'", "rejected"),
        _n("last_verified_at is not null", "vies_verified"),
        _n("nav_checked_at is not null", "nav_checked"),
        _n("contact_checked_at is not null", "contact_checked"),
        _n("places_checked_at is not null", "places_checked"),
        _n("quality_score >= 70", "quality_high"),
        _n("quality_score between 40 and 69", "quality_medium"),
        _n("quality_score < 40", "quality_low"))


def coverage_by_source(lead: DataFrame) -> DataFrame:
    return (lead.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "source"))


def lead_stats(lead: DataFrame, suppression: DataFrame) -> DataFrame:
    """Totals, review split, tax summary and the size of the suppression list."""
    totals = lead.agg(
        F.count(F.lit(1)).alias("total"), _n("email is not null", "with_email"),
        _n("is_personal_data", "personal_data"), _n("review_status = 'PENDING'", "pending"),
        _n("review_status = 'APPROVED'", "approved"), _n("review_status = 'REJECTED'", "rejected"),
        _n("nav_checked_at is not null", "nav_checked"), _n("tax_status = 'ACTIVE'", "active"),
        _n("debt_free", "debt_free"))
    listed = suppression.agg(F.count(F.lit(1)).alias("suppression_entries"))
    # Two one-row aggregates side by side, joined on a constant.
    one = F.lit(1)
    return totals.withColumn("_k", one).join(listed.withColumn("_k", one), "_k").drop("_k")


def region_labels(spark: SparkSession, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return spark.createDataFrame([(r.id, r.name, i) for i, r in enumerate(rules.regions)],
                                 "id string, name string, ord int")


def category_labels(spark: SparkSession, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return spark.createDataFrame([(c.id, c.name, i) for i, c in enumerate(rules.categories)],
                                 "id string, name string, ord int")


def label_join(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Ids to display names, in rule order; ids without rule and zero rows drop."""
    return counts.join(labels, "id").select("ord", "id", "name", "n").orderBy("ord")


def stats_by_region(lead: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    counts = lead.groupBy(F.col("region_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return label_join(counts, region_labels(lead.sparkSession, rules))


def stats_by_category(lead: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    counts = (lead.select(F.explode("categories").alias("id"))
              .groupBy("id").agg(F.count(F.lit(1)).alias("n")))
    return label_join(counts, category_labels(lead.sparkSession, rules))


def cursor_listing(crawl_state: DataFrame) -> DataFrame:
    return (crawl_state.select("source", "region_id", "last_page", "total_seen")
            .orderBy("source", "region_id"))


def source_register(lead: DataFrame) -> DataFrame:
    """Sources that hold data: licence, rows, and rows about natural persons."""
    return lead.groupBy("source", "source_license").agg(
        F.count(F.lit(1)).alias("n_rows"), _n("is_personal_data", "n_personal"))


def batch_by_source(batch: DataFrame, matched: DataFrame) -> DataFrame:
    """fetched, created, merged and skipped per source of a batch.

    An identity is created by the source of its first record; all other kept
    records of a source are merges.
    """
    seen = batch.groupBy("source").agg(F.count(F.lit(1)).alias("fetched"), _n("suppressed", "skipped"))
    created = (matched.filter(~F.col("known")).groupBy("source")
               .agg(F.count(F.lit(1)).alias("created")))
    made = F.coalesce("created", F.lit(0))
    return seen.join(created, "source", "left").select(
        "source", "fetched", made.alias("created"),
        (F.col("fetched") - F.col("skipped") - made).alias("merged"), "skipped")
