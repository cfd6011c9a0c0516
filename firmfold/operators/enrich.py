"""Fill gaps of stored records from lookup tables.

Each step yields an *outcome*: one slim row per candidate with the new values of
the columns it patches, what it counted, and the details of its audit event.
``apply_outcome`` writes the outcome into the master table by its unique key.
The lookup joins are plain left joins on the lookup's unique key: Spark
broadcasts a lookup while its measured size allows it, and otherwise shuffles
and lets AQE split the partition of a domain or name that many leads share.
Candidates without a lookup key get one of their own, so they do not meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmfold.functions.contact import url_domain
from firmfold.functions.identity import norm_company_name, vat_core
from firmfold.functions.score import score_of_row
from firmfold.functions.text import has_text, never_shared
from firmfold.operators.audit import audit_events, audit_meta
from firmfold.schemas import LEAD_COLUMNS

VAT_COLUMNS = ["address", "quality_score", "last_verified_at"]
TAX_COLUMNS = ["tax_status", "debt_free", "employee_count", "nav_checked_at"]
CONTACT_COLUMNS = ["email", "phone", "quality_score", "contact_checked_at"]
PLACE_COLUMNS = ["phone", "website", "domain", "address", "quality_score", "places_checked_at"]


def candidate_limit(rows: DataFrame, limit: int | None) -> DataFrame:
    """First N by lead_id; none or 0 means all."""
    return rows.orderBy("lead_id").limit(limit) if limit else rows


def candidates_vat_check(lead: DataFrame, revalidate: bool = False, limit: int | None = None) -> DataFrame:
    rows = lead.filter(F.col("vat_number").isNotNull())
    return candidate_limit(rows if revalidate else rows.filter("last_verified_at is null"), limit)


def candidates_tax_check(lead: DataFrame, revalidate: bool = False, limit: int | None = None) -> DataFrame:
    rows = lead.filter(F.col("vat_number").isNotNull())
    return candidate_limit(rows if revalidate else rows.filter("nav_checked_at is null"), limit)


def candidates_contact(lead: DataFrame, revalidate: bool = False, limit: int | None = None) -> DataFrame:
    rows = lead.filter("domain is not null and (email is null or phone is null)")
    return candidate_limit(rows if revalidate else rows.filter("contact_checked_at is null"), limit)


def candidates_places(lead: DataFrame, revalidate: bool = False, limit: int | None = None) -> DataFrame:
    rows = lead.filter("phone is null or website is null")
    return candidate_limit(rows if revalidate else rows.filter("places_checked_at is null"), limit)


def _own(key: Column) -> Column:
    return never_shared(key, F.col("dedupe_key"))


def _rescored(changed: str) -> Column:
    return F.when(F.col(changed), score_of_row()).otherwise(F.col("quality_score"))


_KEYS = ["lead_id", "dedupe_key"]
_SCORED = ["email", "phone", "website", "domain", "address", "region_id", "categories",
           "vat_number", "registration_number", "quality_score"]


def verify_vat(lead: DataFrame, register: DataFrame, now: Column, revalidate: bool = False,
               limit: int | None = None) -> DataFrame:
    """Candidates against the VAT register, by the 8-digit core.

    A valid answer fills a missing address; an invalid one only stamps.
    """
    found = register.select("core", F.struct("valid", "address").alias("answer"))
    cand = candidates_vat_check(lead, revalidate, limit).select(
        *_KEYS, *_SCORED, _own(vat_core(F.col("vat_number"))).alias("core"))
    joined = cand.join(found, "core", "left")
    valid = F.coalesce(F.col("answer.valid"), F.lit(False))
    filled = F.when(valid & ~has_text(F.col("address")), F.col("answer.address"))
    out = (joined.select("*", F.col("answer").isNotNull().alias("answered"), valid.alias("valid"),
                         filled.alias("filled"))
           .withColumn("changed", F.col("filled").isNotNull())
           .withColumn("address", F.coalesce("filled", "address")))
    return out.select(
        *_KEYS, "answered", "valid", "changed", "address",
        _rescored("changed").alias("quality_score"), now.alias("last_verified_at"),
        audit_meta(source=F.lit("vies"), valid=F.col("valid")).alias("meta"))


def check_tax(lead: DataFrame, signals: DataFrame, now: Column, revalidate: bool = False,
              limit: int | None = None) -> DataFrame:
    """Candidates against the tax office's signals; no gap filling, no rescoring."""
    found = signals.select("core", F.struct("tax_status", "debt_free", "employee_count").alias("answer"))
    cand = candidates_tax_check(lead, revalidate, limit).select(
        *_KEYS, _own(vat_core(F.col("vat_number"))).alias("core"))
    return cand.join(found, "core", "left").select(
        *_KEYS, F.col("answer").isNotNull().alias("answered"), "answer.tax_status",
        "answer.debt_free", "answer.employee_count", now.alias("nav_checked_at"),
        audit_meta(taxStatus=F.col("answer.tax_status"), debtFree=F.col("answer.debt_free")).alias("meta"))


def enrich_contacts(lead: DataFrame, contacts: DataFrame, now: Column, revalidate: bool = False,
                    limit: int | None = None) -> DataFrame:
    """First e-mail and phone of a site fill what the record lacks."""
    found = contacts.select("domain", F.struct("emails", "phones").alias("answer"))
    cand = candidates_contact(lead, revalidate, limit).select(*_KEYS, *_SCORED)
    joined = cand.join(found, "domain", "left")

    def fill(name: str, found_list: str) -> Column:
        return F.when(~has_text(F.col(name)), F.get(F.col(f"answer.{found_list}"), F.lit(0)))

    out = (joined.select("*", F.col("answer").isNotNull().alias("answered"),
                         fill("email", "emails").alias("new_email"),
                         fill("phone", "phones").alias("new_phone"))
           .withColumn("changed", F.col("new_email").isNotNull() | F.col("new_phone").isNotNull())
           .withColumn("email", F.coalesce("new_email", "email"))
           .withColumn("phone", F.coalesce("new_phone", "phone")))
    return out.select(
        *_KEYS, "answered", "changed", "new_email", "new_phone", "email", "phone",
        _rescored("changed").alias("quality_score"), now.alias("contact_checked_at"),
        F.to_json(F.struct(F.lit("contact-page").alias("source"), F.col("new_email").alias("email"),
                           F.col("new_phone").alias("phone"))).alias("meta"))


def enrich_places(lead: DataFrame, places: DataFrame, now: Column, revalidate: bool = False,
                  limit: int | None = None) -> DataFrame:
    """Place by exact name, else by normalised name; values are kept as given."""
    cand = candidates_places(lead, revalidate, limit).select(
        *_KEYS, *_SCORED, "legal_name", _own(norm_company_name(F.col("legal_name"))).alias("norm_name"))
    place = F.struct("phone", "website", "address")
    exact = places.select(F.col("name").alias("legal_name"), place.alias("exact"))
    close = places.select(F.col("name").alias("norm_name"), place.alias("close"))
    joined = (cand.join(exact, "legal_name", "left").join(close, "norm_name", "left")
              .withColumn("answer", F.coalesce("exact", "close")))

    def fill(name: str) -> Column:
        return F.when(~has_text(F.col(name)), F.col(f"answer.{name}"))

    out = joined.select(
        "*", F.col("answer").isNotNull().alias("answered"), fill("phone").alias("new_phone"),
        fill("website").alias("new_website"), fill("address").alias("new_address"))
    out = (out.withColumn("changed", F.coalesce("new_phone", "new_website", "new_address").isNotNull())
           .withColumn("phone", F.coalesce("new_phone", "phone"))
           .withColumn("domain", F.coalesce(url_domain(F.col("new_website")), "domain"))
           .withColumn("website", F.coalesce("new_website", "website"))
           .withColumn("address", F.coalesce("new_address", "address")))
    return out.select(
        *_KEYS, "answered", "changed", "new_phone", "new_website", "new_address",
        "phone", "website", "domain", "address", _rescored("changed").alias("quality_score"),
        now.alias("places_checked_at"), audit_meta(source=F.lit("places")).alias("meta"))


def apply_outcome(lead: DataFrame, outcome: DataFrame, columns: list[str]) -> DataFrame:
    """Master table with the answered candidates' new values.

    Without an answer nothing is stamped, so the row is a candidate again.
    """
    patch = outcome.filter("answered").select(
        "dedupe_key", F.struct(*columns).alias("_p"))
    joined = lead.join(patch, "dedupe_key", "left")
    hit = F.col("_p").isNotNull()
    return joined.select(*[
        (F.when(hit, F.col(f"_p.{n}")).otherwise(F.col(n)).alias(n) if n in columns else F.col(n))
        for n in LEAD_COLUMNS])


def outcome_events(outcome: DataFrame, type_: str, now: Column, run_id: str) -> DataFrame:
    """VERIFIED and NAV_CHECKED follow every answer, ENRICHED every change."""
    rows = outcome.filter("answered")
    if type_ == "ENRICHED":
        rows = rows.filter("changed")
    return audit_events(rows, F.col("lead_id"), type_, F.col("meta"), now, run_id)


def _n(condition: str, name: str) -> Column:
    return F.count_if(F.expr(condition)).alias(name)


def vat_stats(outcome: DataFrame) -> DataFrame:
    return outcome.agg(F.count(F.lit(1)).alias("scanned"), _n("answered and valid", "valid"),
                       _n("answered and not valid", "invalid"), _n("changed", "enriched"),
                       _n("not answered", "skipped"))


def tax_stats(outcome: DataFrame) -> DataFrame:
    return outcome.agg(F.count(F.lit(1)).alias("scanned"), _n("answered", "checked"),
                       _n("tax_status = 'ACTIVE'", "active"),
                       _n("tax_status = 'SUSPENDED'", "suspended"),
                       _n("tax_status = 'CANCELLED'", "cancelled"),
                       _n("debt_free", "debt_free"), _n("not answered", "skipped"))


def contact_stats(outcome: DataFrame) -> DataFrame:
    return outcome.agg(F.count(F.lit(1)).alias("scanned"), _n("changed", "enriched"),
                       _n("new_email is not null", "emails_added"),
                       _n("new_phone is not null", "phones_added"), _n("not answered", "skipped"))


def places_stats(outcome: DataFrame) -> DataFrame:
    return outcome.agg(F.count(F.lit(1)).alias("scanned"), _n("changed", "enriched"),
                       _n("new_phone is not null", "phones_added"),
                       _n("new_website is not null", "websites_added"),
                       _n("new_address is not null", "addresses_added"), _n("not answered", "skipped"))
