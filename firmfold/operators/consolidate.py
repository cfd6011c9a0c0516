"""Collapse a batch on its identity key, then merge it into the master table.

The merge is a fold in order of arrival. It is written as aggregates that can
be combined in any order: the first non-null value is the one with the least
``seq``, the richest text the longest with the least ``seq``, the category list
the ids by their first appearance. So it pre-aggregates before the shuffle, and
a key that holds a third of the batch costs each map task one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmfold.functions.rules import DEFAULT_RULES
from firmfold.functions.score import score_of_row
from firmfold.schemas import LEAD, LEAD_COLUMNS, LEAD_INPUT_COLUMNS

# The first record's values stay.
IDENTITY = ["legal_name", "source", "source_url", "source_license"]
# The first non-null value stays.
GAPS = ["brand_name", "email", "phone", "website", "domain", "address", "vat_number",
        "registration_number", "region_id"]


def _first_known(name: str, seq: Column) -> Column:
    return F.min_by(name, F.when(F.col(name).isNotNull(), seq)).alias(name)


def _category_aggregates(seq: Column, ids: tuple[str, ...]) -> list[Column]:
    cats = F.col("categories")
    return [F.min(F.when(F.array_contains(cats, i),
                         F.struct(seq.alias("seq"), F.array_position(cats, F.lit(i)).alias("at"))))
            .alias(f"_cat_{n}") for n, i in enumerate(ids)]


def _other_categories(leads: DataFrame, seq: Column, ids: tuple[str, ...]) -> DataFrame:
    """(dedupe_key, _others) for the keys that have ids outside the rule set: each with its first
    appearance. One row per key and id leaves a map task, however many lists a key has."""
    # Rows are cut down behind the explode: a filter before it would be planned as a copy of
    # whatever the lists are made of.
    each = leads.select("dedupe_key", seq.alias("seq"), F.posexplode_outer("categories").alias("at", "id"))
    if ids:
        each = each.filter(~F.col("id").isin(*ids))
    first = each.filter("id is not null").groupBy("dedupe_key", "id").agg(
        F.min(F.struct("seq", (F.col("at") + 1).cast("bigint").alias("at"))).alias("first"))
    return first.groupBy("dedupe_key").agg(F.collect_list(F.struct("first", "id")).alias("_others"))


def _category_list(ids: tuple[str, ...]) -> Column:
    """All ids in order of first appearance."""
    if not ids:
        return F.coalesce(F.transform(F.array_sort("_others"), lambda h: h["id"]), F.array().cast("array<string>"))
    hits = F.filter(F.array(*[F.when(F.col(f"_cat_{n}").isNotNull(),
                                     F.struct(F.col(f"_cat_{n}").alias("first"), F.lit(i).alias("id")))
                              for n, i in enumerate(ids)]), lambda h: h.isNotNull())
    none = F.filter(hits, lambda h: F.lit(False))
    return F.transform(F.array_sort(F.concat(hits, F.coalesce("_others", none))), lambda h: h["id"])


def dedupe_batch(leads: DataFrame, category_ids: tuple[str, ...] = DEFAULT_RULES.category_ids,
                 seq: str = "seq") -> DataFrame:
    """One merged record per dedupe_key, with its count of input records."""
    s = F.col(seq)
    merged = leads.groupBy("dedupe_key").agg(
        F.min(F.struct(s.alias("seq"), *IDENTITY)).alias("_first"),
        *[_first_known(name, s) for name in GAPS],
        F.min_by("classification_text",
                 F.when(F.col("classification_text").isNotNull(),
                        F.struct((-F.length("classification_text")).alias("len"), s.alias("seq"))))
        .alias("classification_text"),
        *_category_aggregates(s, category_ids),
        F.max("is_personal_data").alias("is_personal_data"),
        F.count(F.lit(1)).alias("input_count"))
    merged = merged.join(_other_categories(leads, s, category_ids), "dedupe_key", "left")
    return merged.select(
        "dedupe_key", *[F.col(f"_first.{n}").alias(n) for n in IDENTITY], *GAPS,
        "classification_text", _category_list(category_ids).alias("categories"), "is_personal_data", "input_count",
        F.col("_first.seq").alias("first_seq"))


def match_existing(merged: DataFrame, lead: DataFrame) -> DataFrame:
    """Batch identities with ``known``: is the key stored already?

    Only the key column of the master table is read; where it is bucketed by
    the key, only the batch is shuffled.
    """
    keys = lead.select("dedupe_key", F.lit(True).alias("known"))
    return (merged.join(keys, "dedupe_key", "left")
            .withColumn("known", F.coalesce("known", F.lit(False))))


def lead_id_of(key: Column) -> Column:
    """The same id for a key in every run. Stated as never null, so that joins
    on it do not test the whole expression behind it for null at the scan."""
    return F.coalesce(F.sha2(key, 256), F.lit(""))


def merge_lead(old: str, new: str) -> list[Column]:
    """Merge of a stored record with a batch record, both under an alias."""
    def o(n: str) -> Column:
        return F.col(f"{old}.{n}")

    def w(n: str) -> Column:
        return F.col(f"{new}.{n}")

    text_old, text_new = o("classification_text"), w("classification_text")
    longer = F.coalesce(F.length(text_new), F.lit(0)) > F.coalesce(F.length(text_old), F.lit(0))
    none = F.array().cast("array<string>")
    known = o("dedupe_key").isNotNull()
    out = [F.when(known, o(n)).otherwise(w(n)).alias(n) for n in IDENTITY]
    out += [F.coalesce(o(n), w(n)).alias(n) for n in GAPS]
    out += [
        F.when(longer, text_new).otherwise(F.coalesce(text_old, text_new)).alias("classification_text"),
        F.array_union(F.coalesce(o("categories"), none), F.coalesce(w("categories"), none))
        .alias("categories"),
        (F.coalesce(o("is_personal_data"), F.lit(False))
         | F.coalesce(w("is_personal_data"), F.lit(False))).alias("is_personal_data"),
    ]
    return out


def upsert_lead(lead: DataFrame, merged: DataFrame, now: Column) -> DataFrame:
    """New state of the master table: inserts, merges, untouched rows.

    One full outer join on the unique key. Rows that the batch does not touch
    keep their score; all others are scored again.
    """
    joined = lead.alias("o").join(merged.alias("w"), F.col("o.dedupe_key") == F.col("w.dedupe_key"), "full")
    touched = F.col("w.dedupe_key").isNotNull()
    is_new = F.col("o.dedupe_key").isNull()
    key = F.coalesce("o.dedupe_key", "w.dedupe_key")
    defaults = {"gdpr_basis": F.lit("legitimate_interest"), "lifecycle": F.lit("NEW"),
                "review_status": F.lit("PENDING"), "collected_at": now}
    carried = [n for n in LEAD_COLUMNS
               if n not in LEAD_INPUT_COLUMNS and n not in ("lead_id", "dedupe_key", "quality_score")]
    flat = joined.select(
        F.when(is_new, lead_id_of(key)).otherwise(F.col("o.lead_id")).alias("lead_id"),
        key.alias("dedupe_key"), *merge_lead("o", "w"),
        F.col("o.quality_score").alias("_old_score"), touched.alias("_touched"),
        *[(F.when(is_new, defaults[n]).otherwise(F.col(f"o.{n}")) if n in defaults
           else F.col(f"o.{n}")).alias(n) for n in carried])
    score = F.when(F.col("_touched"), score_of_row()).otherwise(F.col("_old_score"))
    return as_lead(flat.withColumn("quality_score", score))


def as_lead(df: DataFrame) -> DataFrame:
    """Columns in table order and type."""
    types = dict(part.split() for part in LEAD.split(","))
    return df.select(*[F.col(n).cast(types[n]).alias(n) for n in LEAD_COLUMNS])


def empty_lead(like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame([], LEAD)


def ingest_stats(matched: DataFrame) -> DataFrame:
    """created and merged of a batch: a new key makes one row, every further
    record of it, and every record of a known key, is a merge."""
    n = F.col("input_count")
    return matched.agg(
        F.coalesce(F.sum(F.when(F.col("known"), 0).otherwise(1)), F.lit(0)).cast("bigint").alias("created"),
        F.coalesce(F.sum(F.when(F.col("known"), n).otherwise(n - 1)), F.lit(0)).cast("bigint").alias("merged"))
