"""The operator-facing jobs over a store: enrichment, review, governance,
reports, and the scheduled cycle made of them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.functions.rules import DEFAULT_RULES, RuleSet
from firmfold.operators import enrich as E
from firmfold.operators import govern as G
from firmfold.operators import report as R
from firmfold.operators.audit import audit_events
from firmfold.operators.export import export_ndjson
from firmfold.operators.review import REVIEW_COLUMNS, set_review
from firmfold.operators.suppress import add_suppression
from firmfold.plans.ingest import IngestStats, ingest
from firmfold.plans.store import Store


@dataclass(frozen=True)
class Lookups:
    """Lookup tables of the enrichment steps; None skips the step."""

    vat_register: DataFrame | None = None
    tax_signals: DataFrame | None = None
    contacts: DataFrame | None = None
    places: DataFrame | None = None


def _ts(now: datetime):
    return F.lit(now).cast("timestamp")


def _steps(lookups: Lookups, now: datetime, revalidate: bool, limit: int | None):
    """(name, outcome of a master table, patched columns, event type, counters)."""
    stamp = _ts(now)
    plan = [
        ("verify", lookups.vat_register, E.verify_vat, E.VAT_COLUMNS, "VERIFIED", E.vat_stats),
        ("tax", lookups.tax_signals, E.check_tax, E.TAX_COLUMNS, "NAV_CHECKED", E.tax_stats),
        ("contacts", lookups.contacts, E.enrich_contacts, E.CONTACT_COLUMNS, "ENRICHED", E.contact_stats),
        ("places", lookups.places, E.enrich_places, E.PLACE_COLUMNS, "ENRICHED", E.places_stats),
    ]
    for name, table, step, columns, event, stats in plan:
        if table is not None:
            yield (name, lambda lead, step=step, table=table: step(lead, table, stamp, revalidate, limit),
                   columns, event, stats)


def enrich(store: Store, lookups: Lookups, run_id: str, now: datetime, revalidate: bool = False,
           limit: int | None = None) -> dict[str, dict[str, int]]:
    """All given steps in their order, with one rewrite of what they touch.

    A step sees the values its predecessors filled: their outcomes, which are
    slim, are staged and joined to the table on the way.
    """
    lead = store.read("lead")
    stats, events, patches = {}, None, []
    for name, make, columns, event, count in _steps(lookups, now, revalidate, limit):
        outcome = store.stage(run_id, name, make(lead))
        lead = E.apply_outcome(lead, outcome, columns)
        patches.append((outcome, columns))
        # Contacts and places emit the same type, so each step is a run part.
        rows = E.outcome_events(outcome, event, _ts(now), f"{run_id}-{name}").withColumn(
            "run_id", F.lit(run_id))
        events = rows if events is None else events.unionByName(rows)
        stats[name] = count(outcome).first().asDict()
    if stats:
        _patch(store, patches, run_id)
        store.append("audit_event", events, run_id)
    store.end_run(run_id)
    return stats


def _patch(store: Store, patches: list[tuple[DataFrame, list[str]]], run_id: str) -> None:
    """Apply outcomes in their order to the parts that hold an answered record."""
    answered = [outcome.filter("answered").select("dedupe_key") for outcome, _ in patches]

    def change(lead: DataFrame) -> DataFrame:
        for outcome, columns in patches:
            lead = E.apply_outcome(lead, outcome, columns)
        return lead

    store.change_lead(reduce(DataFrame.unionByName, answered), change, run_id)


@dataclass
class RefreshSummary:
    ingest: IngestStats
    verified: int
    nav_checked: int
    contacts_enriched: int
    places_enriched: int


def refresh(store: Store, pages: DataFrame, lookups: Lookups, run_id: str, now: datetime,
            regions: list[str] | None = None, enabled: set[str] = frozenset(),
            rules: RuleSet = DEFAULT_RULES, **ingest_options) -> RefreshSummary:
    """Every enabled source, then the enrichment steps."""
    got = ingest(store, pages, f"{run_id}-ingest", now, regions=regions, enabled=enabled, rules=rules, **ingest_options)
    done = enrich(store, lookups, f"{run_id}-enrich", now)
    return RefreshSummary(got, done.get("verify", {}).get("valid", 0), done.get("tax", {}).get("checked", 0),
                          done.get("contacts", {}).get("enriched", 0),
                          done.get("places", {}).get("enriched", 0))


def recategorize(store: Store, run_id: str, now: datetime, rules: RuleSet = DEFAULT_RULES,
                 limit: int | None = None, dry_run: bool = False) -> dict[str, int]:
    outcome = G.recategorize(store.read("lead"), rules, limit)
    if not dry_run:
        outcome = store.stage(run_id, "recategorize", outcome)
        _patch(store, [(outcome, ["categories"])], run_id)
        store.append("audit_event", E.outcome_events(outcome, "RECATEGORIZED", _ts(now), run_id), run_id)
    stats = G.recategorize_stats(outcome).first().asDict()
    if not dry_run:
        store.end_run(run_id)
    return stats


def review(store: Store, decisions: DataFrame, run_id: str, now: datetime) -> int:
    """Apply decisions; any that cannot be applied stops the job before it writes."""
    outcome = store.stage(run_id, "review", set_review(store.read("lead"), decisions, _ts(now)))
    wrong = outcome.filter("problem is not null").select("lead_id", "problem").head(5)
    if wrong:
        raise ValueError(f"decisions that do not apply, e.g. {[tuple(w) for w in wrong]}")
    _patch(store, [(outcome, REVIEW_COLUMNS)], run_id)
    store.append("audit_event", E.outcome_events(outcome, "REVIEWED", _ts(now), run_id), run_id)
    applied = outcome.count()
    store.end_run(run_id)
    return applied


def suppress(store: Store, entries: DataFrame, run_id: str, now: datetime) -> None:
    store.append("suppression", add_suppression(store.suppressed().limit(0), entries, _ts(now)), run_id)


def _erase(store: Store, doomed: DataFrame, events: DataFrame, run_id: str) -> None:
    """Delete leads and their events, then leave detached events. The caller
    clears the staged frames when it has read them."""
    store.change_lead(doomed, lambda lead: G.erase_leads(lead, doomed), run_id)
    touched = store.read("audit_event").join(doomed.select("lead_id"), "lead_id", "left_semi").select("run_id")
    store.erase_events(lambda held: G.erase_events(held, doomed), touched, run_id)
    store.append("audit_event", events, run_id)


def purge(store: Store, run_id: str, now: datetime, retention_days: int = G.RETENTION_DAYS,
          dry_run: bool = False) -> dict[str, int]:
    decided = G.purge_candidates(store.read("lead"), store.suppressed(), _ts(now), retention_days)
    if not dry_run:
        decided = store.stage(run_id, "purge", decided)
        doomed = decided.filter("reason is not null")
        _erase(store, doomed, G.erasure_events(doomed, "PURGED", _ts(now), run_id, reason=F.col("reason")),
               run_id)
    stats = G.purge_stats(decided).first().asDict()
    if not dry_run:
        store.end_run(run_id)
        store.clear_staged()
    return stats


def dsar_export(store: Store, subjects: DataFrame, path: str, run_id: str, now: datetime) -> None:
    """Write the access report, then log that it was given."""
    report = G.dsar_export(store.read("lead"), store.read("audit_event"), subjects)
    G.write_dsar_report(report, path, _ts(now))
    meta = F.to_json(F.struct(F.lit("export").alias("action")))
    store.append("audit_event", audit_events(report.records, F.col("lead_id"), "DSAR", meta, _ts(now), run_id), run_id)


def dsar_erase(store: Store, subjects: DataFrame, run_id: str, now: datetime) -> int:
    """Erase by exact address and suppress it, held or not."""
    who = subjects.select(G.require_email(F.col("email")).alias("email")).distinct()
    held = store.read("lead").join(who, "email", "left_semi").select(
        "lead_id", "dedupe_key", "source", "region_id")
    doomed = store.stage(run_id, "doomed", held)
    _erase(store, doomed, G.erasure_events(doomed, "DSAR", _ts(now), run_id, action=F.lit("erasure")), run_id)
    suppress(store, who.select(F.col("email").alias("value"), F.lit("EMAIL").alias("kind"),
                               F.lit("erasure request or objection").alias("reason"), F.lit(0).alias("ord")),
             run_id, now)
    erased = doomed.count()
    store.end_run(run_id)
    store.clear_staged()
    return erased


def report(store: Store) -> tuple[dict[str, int], list[tuple[str, int]]]:
    """Coverage of the master table, and its sources by size."""
    lead = store.read("lead")
    return (R.coverage_report(lead).first().asDict(),
            [tuple(r) for r in R.coverage_by_source(lead).collect()])


def export(store: Store, path: str, **filters) -> None:
    export_ndjson(store.read("lead"), path, **filters)


CYCLES = ("full", "enrich", "verify", "purge")


def scheduled_cycle(store: Store, mode: str, run_id: str, now: datetime, pages: DataFrame | None = None,
                    lookups: Lookups = Lookups(), export_path: str | None = None, min_quality: int = 40,
                    **refresh_options) -> dict:
    """Entry point of the four scheduled modes."""
    if mode not in CYCLES:
        raise ValueError(f"unknown mode {mode!r}; known: {', '.join(CYCLES)}")
    out: dict = {}
    if mode == "full":
        out["refresh"] = refresh(store, pages, lookups, run_id, now, **refresh_options)
        out["report"] = report(store)
        if export_path:
            export(store, export_path, min_quality=min_quality)
        out["purge"] = purge(store, f"{run_id}-purge", now)
    elif mode == "enrich":
        out["enrich"] = enrich(store, Lookups(contacts=lookups.contacts), run_id, now)
        out["report"] = report(store)
    elif mode == "verify":
        only = Lookups(vat_register=lookups.vat_register, tax_signals=lookups.tax_signals)
        out["enrich"] = enrich(store, only, run_id, now)
    else:
        out["purge"] = purge(store, run_id, now)
    return out
