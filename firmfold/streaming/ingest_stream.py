"""Landing folder -> master table, as pages arrive."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firmfold.plans.ingest import ingest
from firmfold.plans.store import Store
from firmfold.schemas import AUDIT_EVENT, RAW_PAGES


def ingest_stream(spark: SparkSession, landing: str, store_root: str, checkpoint: str,
                  now: datetime | None = None, parts: int | None = None,
                  max_files_per_batch: int | None = None, **options) -> StreamingQuery:
    """Ingest every page file not seen yet, then stop (availableNow).

    The checkpoint is the cursor of the stream. A micro-batch may be run again
    after a failure: its run id is made of the stream's id, which the checkpoint
    keeps, and the batch number; the store does nothing twice for one run, so
    rows, events and counts stay the same. A micro-batch rewrites only the parts of
    the master table that hold one of its keys. With a new checkpoint all pages are
    ingested again, which leaves the master table as it is.
    """
    reader = spark.readStream.schema(RAW_PAGES)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def one_batch(pages: DataFrame, batch_id: int) -> None:
        store = Store(pages.sparkSession, store_root, parts)
        stamp = now or datetime.now(timezone.utc)
        stream_id = pages.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        ingest(store, pages, f"{stream_id}-{batch_id:012d}", stamp, all_pages=True, **options)

    return (reader.parquet(landing).writeStream.foreachBatch(one_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def audit_stream(spark: SparkSession, events_path: str) -> DataFrame:
    """Running count of audit events per type, each counted when it is appended.

    The folder keeps its path across erasures. Files that an erasure has rewritten hold no
    new event and are ignored; so let the stream come up to date before an erasure, as
    events it has not met by then are not met in their rewritten files.
    """
    events = spark.readStream.schema(AUDIT_EVENT).option("pathGlobFilter", "part-*").parquet(events_path)
    return events.filter("event_id is not null").groupBy("type").agg(F.count(F.lit(1)).alias("n_events"))
