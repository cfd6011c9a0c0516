"""Raw records -> normalised, classified records with their identity key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.functions.classify import classify_text, detect_region
from firmfold.functions.contact import norm_email, norm_phone_hu, url_domain
from firmfold.functions.identity import dedupe_key, looks_personal
from firmfold.functions.rules import DEFAULT_RULES, RuleSet
from firmfold.functions.text import blank_to_null, empty_to_null, fold_text, js_trim
from firmfold.operators.rule_tables import RuleTables, classify_by_rules, regions_by_rules
from firmfold.schemas import LEAD_INPUT_COLUMNS


def normalize_businesses(raw: DataFrame, rules: RuleSet | RuleTables = DEFAULT_RULES) -> DataFrame:
    """One narrow projection; columns beyond the raw ones pass through.

    Rule tables are joined, a rule set is part of the projection.
    """
    c = F.col
    text = empty_to_null(F.concat_ws(" ", *[empty_to_null(c(n)) for n in (
        "classification_text", "legal_name", "brand_name")]))
    extra = [n for n in raw.columns if n not in LEAD_INPUT_COLUMNS]
    # What several outputs are made from becomes a column first: computed once,
    # and the classification above it stays one generated function.
    prepared = raw.select("*", norm_email(c("email")).alias("_email"), text.alias("_text"),
                          fold_text(text).alias("_hay"), fold_text(c("address")).alias("_place"))
    given = F.coalesce(c("categories"), F.array().cast("array<string>"))
    if isinstance(rules, RuleTables):
        prepared = classify_by_rules(prepared, rules, c("_hay"), "_found")
        prepared = regions_by_rules(prepared, rules, c("_place"), "_region")
        found, region = c("_found"), c("_region")
    else:
        found, region = classify_text(c("_hay"), rules, folded=True), detect_region(c("_place"), rules, folded=True)
    return prepared.select(
        js_trim(c("legal_name")).alias("legal_name"),
        blank_to_null(c("brand_name")).alias("brand_name"),
        c("_email").alias("email"),
        norm_phone_hu(c("phone")).alias("phone"),
        blank_to_null(c("website")).alias("website"),
        url_domain(c("website")).alias("domain"),
        blank_to_null(c("address")).alias("address"),
        blank_to_null(c("vat_number")).alias("vat_number"),
        blank_to_null(c("registration_number")).alias("registration_number"),
        region.alias("region_id"),
        F.array_union(found, given).alias("categories"),
        c("_text").alias("classification_text"),
        c("source"), c("source_url"), c("source_license"),
        (F.coalesce(c("is_personal_data"), F.lit(False))
         | looks_personal(c("legal_name"), c("_email"))).alias("is_personal_data"),
        *extra)


def region_fallback(normalised: DataFrame, crawl_region: str = "crawl_region") -> DataFrame:
    """The region that was crawled stands in where the address names none."""
    return normalised.withColumn("region_id", F.coalesce("region_id", crawl_region))


def with_dedupe_key(leads: DataFrame) -> DataFrame:
    """The key of the record as it was seen; it is never derived again."""
    c = F.col
    return leads.withColumn("dedupe_key", dedupe_key(
        c("vat_number"), c("registration_number"), c("domain"), c("legal_name"), c("region_id")))
