"""Contact pages of a site -> one contact set per domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.functions.contact import extract_contacts

# The paths tried on a site, in this order.
CONTACT_PATHS = ["", "/kapcsolat", "/impresszum", "/contact"]


def merge_contact_pages(pages: DataFrame) -> DataFrame:
    """(domain, path, body, fetched_at) -> (domain, emails, phones).

    Paths are taken in their fixed order up to the first one that gave an
    e-mail. One page per (domain, path) is kept, the newest; so the aggregate
    per domain holds one contact set per path, however many copies landed.
    """
    ranks = F.array(*[F.lit(p) for p in CONTACT_PATHS])
    found = (pages.filter(F.col("path").isin(CONTACT_PATHS))
             .select("domain", (F.array_position(ranks, F.col("path")) - 1).alias("path_rank"),
                     "fetched_at", extract_contacts(F.col("body")).alias("c")))
    per_path = [F.max(F.when(F.col("path_rank") == i, F.struct("fetched_at", "c"))).alias(f"p{i}")
                for i in range(len(CONTACT_PATHS))]
    per_domain = found.groupBy("domain").agg(*per_path)
    none = F.array().cast("array<string>")
    emails, phones, done = none, none, F.lit(False)
    for i in range(len(CONTACT_PATHS)):
        e = F.coalesce(F.col(f"p{i}.c.emails"), none)
        p = F.coalesce(F.col(f"p{i}.c.phones"), none)
        emails = F.when(done, emails).otherwise(F.array_union(emails, e))
        phones = F.when(done, phones).otherwise(F.array_union(phones, p))
        done = done | (F.size(e) > 0)
    return per_domain.select("domain", emails.alias("emails"), phones.alias("phones"))
