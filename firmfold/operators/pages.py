"""Page cuts and crawl cursors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from firmfold.functions.rules import DEFAULT_RULES, RuleSet

REGION_KEY = ["source", "region_id"]


def region_expand(spec: str | None, rules: RuleSet = DEFAULT_RULES) -> list[str]:
    """``all`` or a comma-separated list, as the regions of a run, in order."""
    if not spec:
        raise ValueError("a region, a comma-separated list of regions, or 'all' is required")
    if spec == "all":
        return [r.id for r in rules.regions]
    return [part.strip() for part in spec.split(",") if part.strip()]


def resume_cursor(wanted: DataFrame, crawl_state: DataFrame, full: bool = False) -> DataFrame:
    """(source, region_id) -> start_page: the saved page again, or 1.

    One row per source and region, so both sides are tiny.
    """
    if full:
        return wanted.select(*REGION_KEY, F.lit(1).alias("start_page"))
    saved = crawl_state.select(*REGION_KEY, "last_page")
    start = F.coalesce(F.nullif(F.col("last_page"), F.lit(0)), F.lit(1)).cast("int")
    return wanted.join(saved, REGION_KEY, "left").select(*REGION_KEY, start.alias("start_page"))


def page_prefix(page_counts: DataFrame, starts: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Last page of the contiguous run of non-empty pages from the start page.

    ``page_counts``: one row per (source, region_id, page) with n_rows and a
    malformed flag. A page whose successor is absent or empty ends the run;
    finding it is an equi-join of pages with their successors on a unique key
    and one pre-aggregated minimum, so no source or region is sorted in one
    task. Result: source, region_id, start_page, last_page (start - 1 where the
    run is empty) and failed, set where the run hits a malformed page. Without
    ``max_pages`` every landed page may be part of the run.
    """
    inside = page_counts.join(starts, REGION_KEY).filter(
        (F.col("page") >= F.col("start_page")) & (F.lit(max_pages is None) | (F.col("page") <= F.lit(max_pages))))
    full = inside.filter((F.col("n_rows") > 0) & ~F.col("malformed"))
    successor = full.select(*REGION_KEY, (F.col("page") - 1).alias("page"), F.lit(True).alias("goes_on"))
    marked = inside.join(successor, [*REGION_KEY, "page"], "left")
    is_full = (F.col("n_rows") > 0) & ~F.col("malformed")
    at_start = F.col("page") == F.col("start_page")
    runs = marked.groupBy(*REGION_KEY).agg(
        F.max(at_start & is_full).alias("starts"),
        F.min(F.when(is_full & F.col("goes_on").isNull(), F.col("page"))).alias("run_end"))
    last = F.when(F.col("starts"), F.col("run_end")).otherwise(F.col("start_page") - 1).cast("int")
    stop = F.coalesce(last, F.col("start_page") - 1).cast("int")
    ended = starts.join(runs, REGION_KEY, "left").select(*REGION_KEY, "start_page", stop.alias("last_page"))
    # Only the page after the run matters: one row at most.
    bad = inside.filter("malformed").select(*REGION_KEY, (F.col("page") - 1).alias("last_page"),
                                            F.lit(True).alias("failed")).distinct()
    return ended.join(bad, [*REGION_KEY, "last_page"], "left").select(
        *REGION_KEY, "start_page", "last_page", F.coalesce("failed", F.lit(False)).alias("failed"))


def pages_beyond(page_counts: DataFrame, max_pages: int) -> int:
    """How many landed pages a page cap leaves out."""
    return page_counts.filter(F.col("page") > max_pages).count()


def landed_range(page_counts: DataFrame) -> DataFrame:
    """The same columns where every landed page counts (streams: pages come in
    any order, and one that waits for its predecessor would be lost)."""
    return page_counts.groupBy(*REGION_KEY).agg(
        F.min("page").alias("start_page"), F.max("page").alias("last_page"),
        F.lit(False).alias("failed"))


def keep_prefix(pages: DataFrame, prefix: DataFrame) -> DataFrame:
    """Pages inside the run of their source and region, failed regions out."""
    runs = prefix.filter(~F.col("failed")).select(*REGION_KEY, "start_page", "last_page")
    return (pages.join(runs, REGION_KEY)
            .filter(F.col("page").between(F.col("start_page"), F.col("last_page")))
            .drop("start_page", "last_page"))


def record_limit(parsed: DataFrame, page_counts: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Cut the pages of limited sources to their first N records per region.

    Which records of a page are among the first N follows from how many the
    pages before it hold. So only page counts are ordered (a region has as
    many as the page cap allows) and records neither move nor get sorted; other
    sources pass.
    """
    if not limits:
        return parsed
    source = F.col("source")
    limit = None
    for source_id, n in limits.items():
        own = source == source_id
        limit = F.when(own, F.lit(n)) if limit is None else limit.when(own, F.lit(n))
    before = Window.partitionBy(*REGION_KEY).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    takes = page_counts.filter(source.isin(list(limits))).select(
        *REGION_KEY, "page",
        F.greatest(limit - F.coalesce(F.sum("n_rows").over(before), F.lit(0)), F.lit(0)).cast("int").alias("_take"))
    cut = F.when(F.col("_take").isNull(), F.col("records")).otherwise(
        F.slice("records", F.lit(1), F.col("_take")))
    return parsed.join(takes, [*REGION_KEY, "page"], "left").withColumn("records", cut).drop("_take")


def save_cursor(crawl_state: DataFrame, seen: DataFrame, now: Column) -> DataFrame:
    """Upsert of cursors: the page never goes back, counts add up.

    ``seen``: source, region_id, last_page, n_seen (failed regions left out).
    """
    new = seen.select(*REGION_KEY, F.col("last_page").alias("new_page"),
                      F.col("n_seen").alias("new_seen"))
    touched = F.col("new_seen").isNotNull()
    return crawl_state.join(new, REGION_KEY, "full").select(
        *REGION_KEY,
        F.greatest("last_page", "new_page").cast("int").alias("last_page"),
        (F.coalesce("total_seen", F.lit(0)) + F.coalesce("new_seen", F.lit(0)))
        .cast("bigint").alias("total_seen"),
        F.when(touched, now).otherwise(F.col("last_run_at")).alias("last_run_at"))
