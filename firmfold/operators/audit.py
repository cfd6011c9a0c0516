"""Audit events: an append-only table with JSON details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TYPES = ["COLLECTED", "MERGED", "CONTACTED", "OPT_OUT", "DSAR", "VERIFIED", "NAV_CHECKED",
         "ENRICHED", "REGISTERED", "SUPPRESSED_SKIP", "REVIEWED", "RECATEGORIZED", "PURGED"]


def audit_meta(**fields: Column) -> Column:
    """Details as JSON; a null is written, an absent field is not passed."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def audit_events(rows: DataFrame, lead_id: Column, type_: str, meta: Column, now: Column,
                 run_id: str, subject: Column | None = None) -> DataFrame:
    """One event per row. The id follows from the run, so a replay of the run
    writes the same events and not more of them."""
    who = F.coalesce(subject if subject is not None else lead_id, F.lit(""))
    event_id = F.sha2(F.concat_ws("|", F.lit(run_id), F.lit(type_), who), 256)
    return rows.select(event_id.alias("event_id"), lead_id.cast("string").alias("lead_id"),
                       F.lit(type_).alias("type"), meta.alias("meta"), now.alias("created_at"),
                       F.lit(run_id).alias("run_id"))


def ingest_events(batch: DataFrame, matched: DataFrame, now: Column, run_id: str) -> DataFrame:
    """COLLECTED per new identity; MERGED per identity and source that met it
    as a stored one, be it from before this run or from an earlier source."""
    created = audit_events(
        matched.filter(~F.col("known")), F.col("lead_id"), "COLLECTED",
        audit_meta(source=F.col("source"), sourceUrl=F.col("source_url"),
                   license=F.col("source_license")), now, run_id)
    per_source = (batch.filter(~F.col("suppressed")).groupBy("dedupe_key", F.col("source").alias("by"))
                  .agg(F.count(F.lit(1)).alias("n")))
    owners = matched.select("dedupe_key", "lead_id", "known", "source")
    met = per_source.join(owners, "dedupe_key").filter(F.col("known") | (F.col("by") != F.col("source")))
    merged = audit_events(met, F.col("lead_id"), "MERGED", audit_meta(source=F.col("by"), count=F.col("n")),
                          now, run_id, subject=F.concat_ws("|", "lead_id", "by"))
    skipped = (batch.filter("suppressed").groupBy("source")
               .agg(F.count(F.lit(1)).alias("suppressed_count")))
    return created.unionByName(merged).unionByName(
        suppressed_event(skipped, F.col("source"), now, run_id))


def suppressed_event(counts: DataFrame, source: Column, now: Column, run_id: str) -> DataFrame:
    """One detached event with the number of suppressed records, if any."""
    return audit_events(counts.filter(F.col("suppressed_count") > 0), F.lit(None).cast("string"),
                        "SUPPRESSED_SKIP",
                        audit_meta(source=source, count=F.col("suppressed_count")), now, run_id,
                        subject=source)


def audit_rollup(events: DataFrame) -> DataFrame:
    return events.groupBy("type").agg(F.count(F.lit(1)).alias("n_events"),
                                      F.count("lead_id").alias("n_attached"))
