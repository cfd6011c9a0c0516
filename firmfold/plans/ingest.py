"""Landed pages -> master table, for all sources of a run in one pass.

The sources of a run form one batch whose order of arrival is registry order,
region order, page, position. Merging is a fold in that order, so the result
and the counts per source equal those of ingesting source after source, at the
cost of one rewrite of the parts of the master table that the batch touches.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.functions.rules import DEFAULT_RULES, RuleSet
from firmfold.operators.audit import ingest_events
from firmfold.operators.consolidate import dedupe_batch, lead_id_of, match_existing, upsert_lead
from firmfold.operators.normalize import normalize_businesses, region_fallback, with_dedupe_key
from firmfold.operators.pages import (keep_prefix, landed_range, page_prefix, pages_beyond, record_limit,
                                      resume_cursor, save_cursor)
from firmfold.operators.report import batch_by_source
from firmfold.operators.suppress import flag_suppressed
from firmfold.plans.store import Store
from firmfold.sources.pages import bad_pages, explode_records, latest_pages, row_counts, union_sources
from firmfold.sources.registry import gate_sensitive_sources

@dataclass
class IngestStats:
    fetched: int = 0
    created: int = 0
    merged: int = 0
    skipped_suppressed: int = 0
    failed_regions: list[tuple[str, str]] = field(default_factory=list)
    bad_pages: list[tuple[str, str, int]] = field(default_factory=list)
    capped_pages: int = 0
    per_source: dict[str, dict[str, int]] = field(default_factory=dict)


def ingest(store: Store, pages: DataFrame, run_id: str, now: datetime,
           sources: list[str] | None = None, regions: list[str] | None = None,
           enabled: set[str] = frozenset(), full: bool = False, limit: int | None = None,
           max_pages: int | None = None, rules: RuleSet = DEFAULT_RULES,
           all_pages: bool = False) -> IngestStats:
    """One run over landed pages.

    The landing table may hold copies of a page, as each run fetches its last
    page again: the newest counts. ``all_pages`` takes every page instead of the
    run from the cursor to the first gap. Nothing caps pages or records unless
    the caller does; how many pages a cap left out is in the result.
    """
    spark = store.spark
    specs = gate_sensitive_sources(sources, enabled)
    stamp = F.lit(now).cast("timestamp")
    pages = pages.filter(F.col("source").isin([s.id for s in specs]))
    if regions is not None:
        pages = pages.filter(F.col("region_id").isin(regions))
        pairs = [(s.id, r) for s in specs for r in regions]
        wanted = spark.createDataFrame(pairs, "source string, region_id string")
    else:
        wanted = pages.select("source", "region_id").distinct()
    pages = latest_pages(pages)

    # Cursors only steer paginated sources; the others start at their page 1.
    paginated = [s.id for s in specs if s.paginated]
    state = store.read("crawl_state")
    starts = resume_cursor(wanted, state.filter(F.col("source").isin(paginated)), full)
    # Bodies are heavy and parsing them is work: that happens once.
    parsed = store.stage(run_id, "parsed", union_sources(pages, specs, rules))
    counts = row_counts(parsed)
    runs = landed_range(counts) if all_pages else page_prefix(counts, starts, max_pages)
    prefix = store.stage(run_id, "prefix", runs)

    limits = {s.id: s.default_limit if limit is None else limit for s in specs}
    limits = {source: n for source, n in limits.items() if n is not None}
    inside = record_limit(keep_prefix(parsed, prefix), keep_prefix(counts, prefix), limits)
    rows = explode_records(inside, rules, regions)
    leads = with_dedupe_key(region_fallback(normalize_businesses(rows, rules)))
    batch = store.stage(run_id, "batch", flag_suppressed(leads, store.suppressed()))

    kept = store.stage(run_id, "kept", dedupe_batch(batch.filter(~F.col("suppressed")), rules.category_ids))
    matched = store.stage(run_id, "matched", match_existing(kept, store.lead_near(kept))
                          .withColumn("lead_id", lead_id_of(F.col("dedupe_key"))))
    store.change_lead(matched, lambda lead: upsert_lead(lead, matched, stamp), run_id)
    store.append("audit_event", ingest_events(batch, matched, stamp, run_id), run_id)

    seen = batch.groupBy("source", F.col("crawl_region").alias("region_id")).agg(
        F.count(F.lit(1)).alias("n_seen"))
    cursors = (prefix.filter(~F.col("failed") & F.col("source").isin(paginated))
               .join(seen, ["source", "region_id"], "left")
               .select("source", "region_id", "last_page",
                       F.coalesce("n_seen", F.lit(0)).alias("n_seen")))
    store.append("crawl_state", save_cursor(state.limit(0), cursors, stamp), run_id)
    stats = _stats(batch, matched, prefix)
    # Which page stopped a failed region: one row each.
    hit = prefix.filter("failed").select("source", "region_id", (F.col("last_page") + 1).alias("page"))
    stats.bad_pages = [tuple(r) for r in hit.join(bad_pages(parsed), ["source", "region_id", "page"]).collect()]
    if max_pages is not None and not all_pages:
        stats.capped_pages = pages_beyond(counts, max_pages)
    store.end_run(run_id)
    return stats


def _stats(batch: DataFrame, matched: DataFrame, prefix: DataFrame) -> IngestStats:
    """A few rows: at most one per source, and the failed regions."""
    out = IngestStats()
    for row in batch_by_source(batch, matched).collect():
        one = row.asDict()
        out.per_source[one.pop("source")] = one
        out.fetched += one["fetched"]
        out.created += one["created"]
        out.merged += one["merged"]
        out.skipped_suppressed += one["skipped"]
    out.failed_regions = [(r["source"], r["region_id"]) for r in
                          prefix.filter("failed").select("source", "region_id").collect()]
    return out
