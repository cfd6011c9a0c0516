"""Streaming ingest equals batch ingest, and a replayed batch adds nothing."""

from datetime import datetime

from pyspark.sql import functions as F

from firmfold.plans.ingest import ingest
from firmfold.plans.store import Store
from firmfold.schemas import RAW_PAGES
from firmfold.streaming.ingest_stream import audit_stream, ingest_stream
from tests import fixture_pages as P

NOW = datetime(2024, 6, 1, 12, 0, 0)


def _rows(store, name, *columns):
    return sorted(map(tuple, store.read(name).select(*columns).collect()), key=repr)


def _state(store):
    return (_rows(store, "lead", "*"), _rows(store, "audit_event", "lead_id", "type", "meta"),
            _rows(store, "crawl_state", "source", "region_id", "last_page", "total_seen"))


def test_stream_equals_batch_and_survives_replay(spark, tmp_path):
    landing = str(tmp_path / "landing")
    # Two arrivals; the second page of a region comes before its first.
    first = [p for p in P.POI + P.DIRECTORY if not (p[0], p[2]) == ("directory", 1)]
    second = [p for p in P.ALL if p not in first and p[0] != "evny"]

    def run(root, checkpoint):
        q = ingest_stream(spark, landing, str(tmp_path / root), str(tmp_path / checkpoint), now=NOW)
        q.awaitTermination()
        return Store(spark, str(tmp_path / root))

    spark.createDataFrame(first, RAW_PAGES).coalesce(1).write.parquet(landing)
    run("s", "c")
    spark.createDataFrame(second, RAW_PAGES).coalesce(1).write.mode("append").parquet(landing)
    streamed = run("s", "c")

    batch = Store(spark, str(tmp_path / "b"))
    for i, pages in enumerate((first, second)):
        ingest(batch, spark.createDataFrame(pages, RAW_PAGES).coalesce(1), f"r{i}", NOW, all_pages=True)
    assert _state(streamed) == _state(batch)
    assert streamed.read("lead").count() == 9 - 1

    before = _state(streamed)
    run("s", "c")                      # nothing new has landed
    assert _state(streamed) == before
    # A batch whose commit was lost is run again, under the same run id.
    (tmp_path / "c" / "commits" / "1").unlink()
    (tmp_path / "c" / "commits" / ".1.crc").unlink(missing_ok=True)
    run("s", "c")
    assert _state(streamed) == before

    # Events as a stream of their own.
    path = f"{tmp_path}/s/audit_event"
    q = (audit_stream(spark, path).writeStream.outputMode("complete").format("memory").queryName("kinds")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    kinds = {r["type"]: r["n_events"] for r in spark.table("kinds").collect()}
    assert kinds == {r["type"]: r["n"] for r in streamed.read("audit_event").groupBy("type").agg(
        F.count(F.lit(1)).alias("n")).collect()}

    # A new checkpoint reads everything again: no row of the master table changes.
    run("s", "fresh")
    assert _rows(streamed, "lead", "*") == before[0]
