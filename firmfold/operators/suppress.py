"""The do-not-contact list: matching and maintenance.

A record has three keys: its e-mail, that address's domain, its site's domain. E-mail and
site decide all of them, so both together are the record's *row key*. Row keys and what they
hold, slim and each once, meet the list in one equi-join; the records then meet the row keys
that were hit. Records without any key take part in neither, so no empty key is ever dealt
out. Spark broadcasts the list, or the hits, while their measured size is below the
threshold; beyond it the joins shuffle, and AQE splits the partitions of a domain that a
third of all records may share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmfold.functions.contact import url_domain
from firmfold.functions.identity import suppression_keys
from firmfold.functions.text import js_trim

_ROW_KEY = "_row_key"


def _with_key(rows: DataFrame, email: Column, domain: Column) -> DataFrame:
    """The rows with one text for their keys, null where they have none.

    It passes through an explode of one value: filters on it then stay filters on a column,
    rather than copies of the expressions that address and site are made of.
    """
    by_email, _, by_domain = suppression_keys(email, domain)
    key = F.concat(F.coalesce(by_email, F.lit("")), F.lit("\x01"), F.coalesce(by_domain, F.lit("")))
    return rows.select("*", F.explode(F.array(F.nullif(key, F.lit("\x01")))).alias(_ROW_KEY))


def _hit_keys(rows: DataFrame, suppression: DataFrame, email: Column, domain: Column) -> DataFrame:
    """The row keys of which any part is listed, whatever the kind of the entry."""
    keys = _with_key(rows.select(email.alias("email"), domain.alias("domain")), F.col("email"), F.col("domain"))
    keys = keys.select(_ROW_KEY).filter(F.col(_ROW_KEY).isNotNull()).distinct()
    by_email, by_domain = (F.split(_ROW_KEY, "\x01")[k] for k in (0, 1))
    parts = F.array(by_email, F.get(F.split(by_email, "@"), F.lit(1)), by_domain)
    held = keys.select(_ROW_KEY, F.explode(parts).alias("value")).filter("value <> ''")
    return held.join(suppression.select("value"), "value", "left_semi").select(_ROW_KEY).distinct()


def _keyed(rows: DataFrame, suppression: DataFrame, email: Column, domain: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records with their row key, records without, and the keys that were hit."""
    key = F.col(_ROW_KEY)
    marked = _with_key(rows, email, domain)
    return marked.filter(key.isNotNull()), marked.filter(key.isNull()).drop(_ROW_KEY), _hit_keys(rows, suppression, email, domain)


def anti_suppressed(rows: DataFrame, suppression: DataFrame) -> DataFrame:
    """Records none of whose keys is listed."""
    keyed, free, hit = _keyed(rows, suppression, F.col("email"), F.col("domain"))
    return keyed.join(hit, _ROW_KEY, "left_anti").drop(_ROW_KEY).unionByName(free)


def flag_suppressed(rows: DataFrame, suppression: DataFrame) -> DataFrame:
    """All records, with a boolean ``suppressed``."""
    keyed, free, hit = _keyed(rows, suppression, F.col("email"), F.col("domain"))
    flagged = keyed.join(hit.withColumn("_hit", F.lit(True)), _ROW_KEY, "left")
    flagged = flagged.select(*rows.columns, F.coalesce("_hit", F.lit(False)).alias("suppressed"))
    return flagged.unionByName(free.withColumn("suppressed", F.lit(False)))


def is_suppressed(values: DataFrame, suppression: DataFrame) -> DataFrame:
    """Addresses that are listed, or whose domain is: (email) -> (email).

    For ``domain`` columns use :func:`is_domain_suppressed`.
    """
    keyed, _, hit = _keyed(values, suppression, F.col("email"), F.lit(None).cast("string"))
    return keyed.join(hit, _ROW_KEY, "left_semi").drop(_ROW_KEY)


def is_domain_suppressed(values: DataFrame, suppression: DataFrame) -> DataFrame:
    """Domains that are listed as domains: (domain) -> (domain)."""
    keyed = values.withColumn("_k", F.lower(js_trim(F.col("domain"))))
    listed = suppression.filter("kind = 'DOMAIN'").select(F.col("value").alias("_k"))
    return keyed.join(listed, "_k", "left_semi").select(*values.columns)


def suppression_value(value: Column, kind: Column) -> Column:
    plain = F.lower(js_trim(value))
    return F.when(kind == "EMAIL", plain).otherwise(F.coalesce(url_domain(value), plain))


def add_suppression(suppression: DataFrame, entries: DataFrame, now: Column) -> DataFrame:
    """Upsert by normalised value: newest reason, first kind and date stay.

    ``entries``: value, kind (null: an @ makes it an e-mail), reason, and ord,
    the order in which they were made.
    """
    kind = F.coalesce("kind", F.when(F.col("value").contains("@"), "EMAIL").otherwise("DOMAIN"))
    added = (entries.withColumn("kind", kind)
             .select(suppression_value(F.col("value"), F.col("kind")).alias("value"), "kind",
                     F.coalesce("reason", F.lit("manual")).alias("reason"),
                     now.alias("created_at"), F.col("ord").cast("bigint").alias("ord")))
    known = suppression.select("value", "kind", "reason", "created_at",
                               F.lit(-1).cast("bigint").alias("ord"))
    return known.unionByName(added).groupBy("value").agg(
        F.min_by("kind", "ord").alias("kind"),
        F.max_by("reason", "ord").alias("reason"),
        F.min_by("created_at", "ord").alias("created_at"))
