"""Human review: the queue, the decisions, and listings by quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmfold.functions.score import review_reasons

# The two decisions and the status each one sets.
DECISIONS = {"approve": "APPROVED", "reject": "REJECTED"}
REVIEW_COLUMNS = ["review_status", "review_note", "reviewed_at"]


def queue_order() -> list[Column]:
    """Non-personal records first, then by score; the id makes the order total,
    so a range-partitioned sort can split any tie."""
    return [F.asc("is_personal_data"), F.desc("quality_score"), F.asc("lead_id")]


def top_quality() -> list[Column]:
    return [F.desc("quality_score"), F.asc("lead_id")]


def list_leads(lead: DataFrame, region: str | None = None, category: str | None = None,
               min_quality: int = 0, limit: int | None = None) -> DataFrame:
    """Best ``limit`` of a region (all without one); the category is filtered *after* the cut.

    A limit is a top-k: its rows end in one task.
    """
    rows = lead.filter(F.col("quality_score") >= min_quality)
    if region:
        rows = rows.filter(F.col("region_id") == region)
    best = rows.orderBy(*top_quality())
    best = best if limit is None else best.limit(limit)
    if category:
        best = best.filter(F.array_contains("categories", category))
    return best.select("lead_id", "quality_score", "legal_name", "region_id", "categories",
                       F.coalesce("email", "phone").alias("contact"), "is_personal_data")


def review_queue(lead: DataFrame, region: str | None = None, category: str | None = None,
                 limit: int | None = None) -> DataFrame:
    """Pending records in queue order; here a limit of 0 gives no rows."""
    rows = lead.filter("review_status = 'PENDING'")
    if region:
        rows = rows.filter(F.col("region_id") == region)
    if category:
        rows = rows.filter(F.array_contains("categories", category))
    c = F.col
    items = rows.select(
        "lead_id", "legal_name", "region_id", "categories", "quality_score", "is_personal_data",
        F.coalesce("email", "phone").alias("contact"),
        review_reasons(c("email"), c("phone"), c("categories"), c("quality_score"),
                       c("is_personal_data")).alias("reasons")).orderBy(*queue_order())
    return items if limit is None else items.limit(limit)


def set_review(lead: DataFrame, decisions: DataFrame, now: Column) -> DataFrame:
    """Outcome of decisions (lead_id, action, note, ord); the last one counts.

    Every decision comes back: ``answered`` where it applies, else ``problem``
    says why not.
    """
    last = decisions.groupBy("lead_id").agg(F.max_by(F.struct("action", "note"), "ord").alias("d"))
    status = F.lit(None).cast("string")
    for action, value in DECISIONS.items():
        status = F.when(F.col("d.action") == action, F.lit(value)).otherwise(status)
    joined = last.join(lead.select("lead_id", "dedupe_key", "legal_name"), "lead_id", "left")
    out = joined.select("lead_id", "dedupe_key", "legal_name", status.alias("review_status"),
                        F.col("d.note").alias("review_note"), now.alias("reviewed_at"))
    problem = (F.when(F.col("review_status").isNull(), F.lit("unknown action"))
               .when(F.col("dedupe_key").isNull(), F.lit("unknown lead")))
    meta = F.to_json(F.struct(F.col("review_status").alias("status"),
                              F.nullif("review_note", F.lit("")).alias("note")))
    return out.withColumn("problem", problem).withColumn(
        "answered", F.col("problem").isNull()).withColumn("meta", meta)
