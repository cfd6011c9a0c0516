"""URL filters as a temporal list join, with DataFrame functions only.

A list is a history: dated entries (pattern, action, time) say from when on a pattern is
to ``block``, to ``allow`` or no longer listed (``drop``). Entries become validity
intervals, each up to the pattern's next entry. A capture is judged by the entries that
were active when it was fetched; the most specific of them decides.

Patterns are host suffixes on label bounds (``example.com`` also means its subdomains)
or a host with leading path segments (``www.example.com/a/b``). A URL has a short chain
of patterns, from its top-level domain to its whole path, each more specific than the
one before. Chain and intervals meet in an equi-join on (pattern, time bucket):
intervals are clipped to the buckets they touch, so neither a long history nor an open
interval makes a capture meet more than the entries of one bucket, and a hot host's
captures can be split by adaptive execution, as they need no common task. What a chain
finds is brought together by a combinable maximum.

Defined results: a capture without a readable host, or with a null time, has no active
entry and is kept; entries with a null or unknown field are ignored; of entries of one
pattern and time, block goes before allow before drop; repeated captures give one row
each; an empty list keeps all, an empty table of captures gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmfold.llm.common import bound, pick

BUCKET_DAYS = 30
ACTIONS = ("block", "allow", "drop")
# Scheme, optional user part, host without port; then the path up to query or fragment.
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
_PATH = r"^[^:]+://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without a trailing dot; an empty text if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.+$", "")


def patterns_of(url: Column) -> Column:
    """The URL's patterns, from its last label to its whole path."""
    labels = F.split(host_of(url), r"\.")
    segments = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda x: x != "")

    def suffixes(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(x)), lambda k: F.array_join(F.slice(x, F.size(x) - k + 1, k), "."))

    def prefixes(x: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(x)), lambda k: F.concat(
            host_of(url), F.lit("/"), F.array_join(F.slice(x, F.lit(1), k), "/")))
        return F.when(F.size(x) > 0, each).otherwise(F.array().cast("array<string>"))

    chain = F.concat(bound(labels, suffixes), bound(segments, prefixes))
    return F.when(host_of(url) != "", chain).otherwise(F.array().cast("array<string>"))


def _bucket(time: Column, days: int) -> Column:
    return F.floor(F.unix_seconds(time) / (86400 * days))


def intervals(entries: DataFrame, pattern_col: str = "pattern", action_col: str = "action",
              time_col: str = "effective_at") -> DataFrame:
    """(pattern, action, since, until) of the dated entries; ``until`` is null for the last one."""
    rows = pick(entries, pattern=pattern_col, action=action_col, since=time_col).filter(
        F.col("pattern").isNotNull() & F.col("since").isNotNull() & F.col("action").isin(*ACTIONS))
    rank = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    single = rows.groupBy(F.lower("pattern").alias("pattern"), "since").agg(F.min_by("action", rank).alias("action"))
    following = F.lead("since").over(Window.partitionBy("pattern").orderBy("since"))
    return single.withColumn("until", following).select("pattern", "action", "since", "until")


def judge(captures: DataFrame, entries: DataFrame, bucket_days: int = BUCKET_DAYS, id_col: str = "page_id",
          url_col: str = "url", time_col: str = "fetched_at", **entry_columns: str) -> DataFrame:
    """One row per capture: id, url, time, ``n_active`` entries, the deciding ``pattern`` with its ``action``
    and ``since``, and ``kept``."""
    active = intervals(entries, **entry_columns)
    # After the list's last date nothing changes: later buckets are the last one.
    newest = active.agg(F.max("since")).first()[0]
    last = F.lit(0 if newest is None else int(newest.timestamp() // (86400 * bucket_days))).cast("bigint")
    until = F.coalesce(_bucket(F.col("until"), bucket_days), last)
    clipped = active.filter("action <> 'drop'").withColumn(
        "bucket", F.explode(F.sequence(_bucket(F.col("since"), bucket_days), until)))

    rows = pick(captures, id=id_col, url=url_col, at=time_col).groupBy("id", "url", "at").agg(F.count(F.lit(1)).alias("copies"))
    chain = rows.select("*", F.posexplode_outer(patterns_of(F.col("url"))).alias("rank", "pattern"))
    chain = chain.withColumn("pattern", F.lower("pattern")).withColumn(
        "bucket", F.least(_bucket(F.col("at"), bucket_days), last))
    met = chain.alias("c").join(
        clipped.alias("i"), (F.col("c.pattern") == F.col("i.pattern")) & (F.col("c.bucket") == F.col("i.bucket"))
        & (F.col("i.since") <= F.col("c.at")) & (F.col("i.until").isNull() | (F.col("c.at") < F.col("i.until"))), "left")
    decided = F.max_by(F.struct("i.pattern", "i.action", "i.since"), F.when(F.col("i.action").isNotNull(), F.col("rank")))
    out = met.groupBy("id", "url", "at", "copies").agg(F.count("i.action").alias("n_active"), decided.alias("d"))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return out.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("at").alias(time_col), "n_active",
        F.col("d.pattern").alias("pattern"), F.col("d.action").alias("action"), F.col("d.since").alias("since"),
        F.coalesce(F.col("d.action") == "allow", F.lit(True)).alias("kept"))
