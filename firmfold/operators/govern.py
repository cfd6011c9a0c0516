"""Retention, erasure, access reports and recategorisation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmfold.functions.classify import classify_text
from firmfold.functions.contact import norm_email
from firmfold.functions.rules import DEFAULT_RULES, RuleSet
from firmfold.functions.score import purge_decision
from firmfold.functions.text import empty_to_null, fold_text, has_text, iso_timestamp
from firmfold.operators.audit import audit_events, audit_meta
from firmfold.operators.rule_tables import RuleTables, classify_by_rules
from firmfold.operators.suppress import flag_suppressed

RETENTION_DAYS = 365


def purge_candidates(lead: DataFrame, suppression: DataFrame, now: Column,
                     retention_days: int = RETENTION_DAYS) -> DataFrame:
    """Records with the reason for which they must go (null: keep).

    Only the eight columns that the decision and its event need are read.
    """
    slim = lead.select("lead_id", "dedupe_key", "email", "domain", "is_personal_data", "lifecycle",
                       "collected_at", "source", "region_id")
    c = F.col
    return flag_suppressed(slim, suppression).select(
        "lead_id", "dedupe_key", "source", "region_id",
        purge_decision(c("suppressed"), c("is_personal_data"), c("lifecycle"), c("collected_at"),
                       now, retention_days).alias("reason"))


def purge_stats(decided: DataFrame) -> DataFrame:
    return decided.agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("reason") == "SUPPRESSED").alias("suppressed"),
        F.count_if(F.col("reason") == "PERSONAL_DATA_EXPIRED").alias("expired"))


def erase_leads(lead: DataFrame, doomed: DataFrame) -> DataFrame:
    """Master table without the doomed rows (anti join on the unique key)."""
    return lead.join(doomed.select("dedupe_key"), "dedupe_key", "left_anti")


def erase_events(events: DataFrame, doomed: DataFrame) -> DataFrame:
    """Audit table without the events attached to doomed leads.

    Detached events have no lead; they skip the join. One lead may hold a large
    part of all events: AQE splits its partition of the left side.
    """
    attached = events.filter("lead_id is not null")
    kept = attached.join(doomed.select("lead_id"), "lead_id", "left_anti")
    return kept.select(*events.columns).unionByName(events.filter("lead_id is null"))


def erasure_events(doomed: DataFrame, type_: str, now: Column, run_id: str, **details: Column) -> DataFrame:
    """Detached events that say what was erased and hold no personal data."""
    meta = audit_meta(leadId=F.col("lead_id"), source=F.col("source"), regionId=F.col("region_id"), **details)
    return audit_events(doomed, F.lit(None).cast("string"), type_, meta, now, run_id,
                        subject=F.col("lead_id"))


def require_email(raw: Column) -> Column:
    """Normalised address; anything else is an error of the request."""
    email = norm_email(raw)
    return F.when(email.isNotNull(), email).otherwise(
        F.raise_error(F.concat(F.lit("not a valid e-mail: "), F.coalesce(raw, F.lit("(null)")))))


@dataclass(frozen=True)
class AccessReport:
    """Answer to access requests, flat: one row per record, one per event.

    An audit trail has no size bound, so it stays a table; it is never
    collected into one row. ``trail`` carries ``trail_no`` order columns.
    """

    records: DataFrame
    trail: DataFrame


def dsar_export(lead: DataFrame, events: DataFrame, subjects: DataFrame) -> AccessReport:
    """Everything held about the subjects (one column ``email``)."""
    who = subjects.select(require_email(F.col("email")).alias("email")).distinct()
    held = lead.join(who, "email", "left_semi")
    records = held.select(
        F.col("email").alias("subject"), "lead_id", "legal_name", "brand_name", "email", "phone",
        "website", "domain", "address", "vat_number", "registration_number", "region_id",
        "categories", "is_personal_data", "gdpr_basis", "quality_score", "lifecycle", "source",
        "source_url", "source_license", iso_timestamp(F.col("collected_at")).alias("collected_at"),
        iso_timestamp(F.col("last_verified_at")).alias("last_verified_at"))
    owners = held.select(F.col("email").alias("subject"), "lead_id")
    trail = events.select("lead_id", "event_id", "type", "meta", "created_at").join(owners, "lead_id").select(
        "subject", "lead_id", "type", "meta", iso_timestamp(F.col("created_at")).alias("created_at"),
        F.col("created_at").alias("at"), "event_id")
    return AccessReport(records, trail)


def dsar_documents(report: AccessReport) -> DataFrame:
    """Records with the number of their events; the events are ``report.trail``."""
    counts = report.trail.groupBy("lead_id").agg(F.count(F.lit(1)).alias("trail_events"))
    return report.records.join(counts, "lead_id", "left").withColumn(
        "trail_events", F.coalesce("trail_events", F.lit(0)))


def write_dsar_report(report: AccessReport, path: str, generated_at: Column) -> None:
    """Three folders of JSON lines, of one shape at every size: subjects, records,
    and the trails in order of record and time.

    The trail is derived once: the records' counts are those of the lines that were written.
    """
    def write(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")

    write(report.trail.orderBy("lead_id", "at", "event_id").drop("at", "event_id"), "trail")
    written = report.trail.sparkSession.read.schema("lead_id string").json(f"{path}/trail")
    write(dsar_documents(AccessReport(report.records, written)), "records")
    write(report.records.groupBy("subject").agg(F.count(F.lit(1)).alias("lead_count"))
          .withColumn("generated_at", iso_timestamp(generated_at)), "subjects")


def recategorize(lead: DataFrame, rules: RuleSet | RuleTables = DEFAULT_RULES, limit: int | None = None) -> DataFrame:
    """Outcome of classifying the stored text again; categories are replaced.

    Categories that came from codes go; the score stays as it is.
    """
    rows = lead.orderBy("lead_id").limit(limit) if limit else lead
    names = F.concat_ws(" ", empty_to_null(F.col("legal_name")), empty_to_null(F.col("brand_name")))
    text, fallback = F.coalesce("classification_text", names), ~has_text(F.col("classification_text"))
    kept = ["lead_id", "dedupe_key", F.col("categories").alias("previous"), fallback.alias("fallback")]
    if isinstance(rules, RuleTables):
        out = classify_by_rules(rows.select(*kept, fold_text(text).alias("hay")), rules, F.col("hay")).drop("hay")
    else:
        out = rows.select(*kept, classify_text(text, rules).alias("categories"))
    return out.withColumn("answered", ~same_category_set(F.col("previous"), F.col("categories"))).withColumn(
        "meta", F.to_json(F.struct(F.col("previous").alias("from"), F.col("categories").alias("to"))))


def same_category_set(a: Column, b: Column) -> Column:
    return F.array_sort(a) == F.array_sort(b)


def recategorize_stats(outcome: DataFrame) -> DataFrame:
    cleared = (F.size("previous") > 0) & (F.size("categories") == 0)
    return outcome.agg(F.count(F.lit(1)).alias("scanned"),
                       F.count_if("answered").alias("changed"),
                       F.count_if(F.col("answered") & cleared).alias("cleared"),
                       F.count_if("fallback").alias("fallback"))
