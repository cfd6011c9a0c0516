"""Landing table -> parsed pages -> raw rows, for one source or many."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmfold.functions.rules import DEFAULT_RULES, RuleSet
from firmfold.schemas import RAW_PAGES, SEQ
from firmfold.sources.registry import SourceSpec, source_ordinal


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_PAGES).parquet(path)


def latest_pages(pages: DataFrame) -> DataFrame:
    """One body per (source, region, page): the one fetched last.

    The key is the page itself, so no group is large unless one page was landed
    over and over, and those copies already meet in the partial aggregate.
    """
    newest = F.max(F.struct("fetched_at", "body")).alias("newest")
    return (pages.groupBy("source", "region_id", "page").agg(newest)
            .select("source", "region_id", "page", "newest.body", "newest.fetched_at"))


def union_sources(pages: DataFrame, specs: list[SourceSpec], rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Pages of all sources of a run with their records, in one narrow pass.

    Each page goes through the parser of its own source (a CASE, evaluated row
    by row), so the landing table is scanned once however many sources it holds.
    """
    parsed, order = None, None
    for spec in specs:
        own = F.col("source") == spec.id
        page, ordinal = spec.parse(F.col("body"), spec.provenance, rules), F.lit(source_ordinal(spec.id))
        parsed = F.when(own, page) if parsed is None else parsed.when(own, page)
        order = F.when(own, ordinal) if order is None else order.when(own, ordinal)
    wanted = pages.filter(F.col("source").isin([s.id for s in specs]))
    return (wanted.select("source", "region_id", "page", order.alias("source_ord"), parsed.alias("parsed"))
            .select("source", "region_id", "page", "source_ord", "parsed.records", "parsed.malformed",
                    F.size("parsed.records").alias("n_rows")))


def parse_pages(pages: DataFrame, spec: SourceSpec, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return union_sources(pages, [spec], rules)


def bad_pages(parsed: DataFrame) -> DataFrame:
    return parsed.filter("malformed").select("source", "region_id", "page")


def row_counts(parsed: DataFrame) -> DataFrame:
    """The page-level table: no records."""
    return parsed.select("source", "region_id", "page", "malformed", "n_rows")


def region_order(regions: list[str]):
    """Ordinal of a page's region in a run; regions not named come last."""
    known = F.array_position(F.array(*[F.lit(r) for r in regions]), F.col("region_id"))
    return F.when(known > 0, known).otherwise(F.lit(len(regions) + 1)).cast("int")


def explode_records(parsed: DataFrame, rules: RuleSet = DEFAULT_RULES,
                    regions: list[str] | None = None) -> DataFrame:
    """One row per record, with its place in the order of arrival (``seq``).

    Regions count in the order of the request, by default that of the rules.
    """
    regions = regions if regions is not None else [r.id for r in rules.regions]
    rows = parsed.select("source_ord", F.col("region_id").alias("crawl_region"), "page",
                         region_order(regions).alias("region_ord"),
                         F.posexplode("records").alias("pos", "r"))
    seq = F.struct("source_ord", "region_ord", "page", "pos").cast(SEQ)
    return rows.select("r.*", "crawl_region", "page", "pos", seq.alias("seq"))
