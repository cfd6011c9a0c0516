"""Stored tables as partitioned Parquet folders on shared storage: read, write, swap.

* The master table is cut into ``parts`` by a hash of ``dedupe_key``. A change names the
  keys it is about; only the parts that hold one of them are read, changed and swapped by
  Spark's dynamic partition overwrite, so a small batch costs a small rewrite.
* Cursors, suppressions and events are logs with a partition per run: a run that is started
  again overwrites its own partition and nothing else. Cursors and suppressions are read as
  what the log adds up to.
* An erasure rewrites the event partitions that hold an erased record. Rewritten files have
  a name of their own (``kept-…``), which a stream over the folder is told to ignore.

All writes are such that doing them again changes nothing: a merge of a record that was
merged already, a patch that was applied, a deletion of what is gone. So a run that was cut
off is simply started again, and only one run writes at a time. A swapped or rewritten
partition keeps a row without a key, as an empty one would not be swapped at all. Its rows are
rebalanced by partition: few files of a small one, but a large one is cut among many tasks, so
that a run that holds most of all events is not rewritten by one.

What several steps of a run read is staged below ``runs/``; a staged frame counts once its
write was committed. A run that has ended does nothing when it is started again.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmfold.schemas import LEAD_COLUMNS, TABLES

_SWAP = {"partitionOverwriteMode": "dynamic"}


class Store:
    def __init__(self, spark: SparkSession, root: str, parts: int | None = None):
        """``parts`` counts for a new store; one that is there keeps its own."""
        self.spark = spark
        self.root = root.rstrip("/")
        self._wanted = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # -- files ------------------------------------------------------------------

    def _files(self, path: str):
        """The path in its file system, whatever that is."""
        there = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return there.getFileSystem(self.spark._jsc.hadoopConfiguration()), there

    def _exists(self, path: str) -> bool:
        files, there = self._files(path)
        return files.exists(there)

    def _table(self, name: str, schema: str) -> DataFrame:
        if not self._exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _write(self, rows: DataFrame, name: str, by: str, **options: str) -> None:
        rows.write.mode("overwrite").options(**_SWAP, **options).partitionBy(by).parquet(f"{self.root}/{name}")

    # -- runs -------------------------------------------------------------------

    def ended(self, run_id: str) -> bool:
        return self._exists(f"ended/{run_id}")

    def end_run(self, run_id: str) -> None:
        """All tables of the run are written."""
        files, there = self._files(f"ended/{run_id}")
        files.createNewFile(there)

    def stage(self, run_id: str, name: str, frame: DataFrame) -> DataFrame:
        """Write a frame that several steps read; a run that is started again reads it back."""
        path = f"runs/{run_id}/{name}"
        if not self._exists(f"{path}/_SUCCESS"):
            if self.ended(run_id):  # its frames are gone, and its work is done
                return self.spark.createDataFrame([], frame.schema)
            frame.write.mode("overwrite").parquet(f"{self.root}/{path}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.root}/{path}")

    def clear_staged(self) -> None:
        """Remove the staged frames of all runs: an erasure must reach them too. A run that was
        cut off computes them anew, with the suppressions that hold by then."""
        files, there = self._files("runs")
        files.delete(there, True)

    # -- reading ----------------------------------------------------------------

    def read(self, name: str) -> DataFrame:
        if name == "lead":
            return self._lead().drop("part")
        rows = self._table(name, TABLES[name] if "run_id" in TABLES[name] else f"{TABLES[name]}, run_id string")
        if name == "audit_event":
            return rows.filter("event_id is not null")
        if name == "crawl_state":
            return rows.groupBy("source", "region_id").agg(
                F.max("last_page").alias("last_page"), F.sum("total_seen").alias("total_seen"),
                F.max("last_run_at").alias("last_run_at"))
        # The newest reason; kind and date of the first entry.
        order = F.struct("created_at", "run_id")
        return rows.groupBy("value").agg(
            F.min_by("kind", order).alias("kind"), F.max_by("reason", order).alias("reason"), F.min("created_at").alias("created_at"))

    def suppressed(self) -> DataFrame:
        """The suppression log as it is: what only asks whether a value is listed need not add it up."""
        return self._table("suppression", f"{TABLES['suppression']}, run_id string").drop("run_id")

    # -- the master table -------------------------------------------------------

    def _lead(self) -> DataFrame:
        return self._table("lead", f"{TABLES['lead']}, part int").filter("dedupe_key is not null")

    def parts(self) -> int:
        """Number of parts, fixed with the first write."""
        if not self._exists("layout/_SUCCESS"):
            self.spark.range(1).select(F.lit(self._wanted).alias("parts")).write.mode("overwrite").parquet(f"{self.root}/layout")
        return self.spark.read.parquet(f"{self.root}/layout").first()["parts"]

    def part_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts())).cast("int")

    def _touched(self, keys: DataFrame) -> list[int]:
        """The parts that hold a key: whole numbers, at most ``parts`` of them."""
        found = keys.filter("dedupe_key is not null").select(self.part_of(F.col("dedupe_key")).alias("part")).distinct()
        return [r["part"] for r in found.collect()]

    def _held(self, touched: list[int]) -> DataFrame:
        return self._lead().filter(F.col("part").isin(touched)).drop("part")

    def lead_near(self, keys: DataFrame) -> DataFrame:
        """The rows of the parts that hold a key of ``keys``; other parts are not read."""
        return self._held(self._touched(keys))

    def change_lead(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame], run_id: str) -> None:
        """Swap the parts that hold a key of ``keys`` for what ``change`` makes of their rows."""
        touched = [] if self.ended(run_id) else self._touched(keys)
        if not touched:
            return
        held, part = self._held(touched), self.part_of(F.col("dedupe_key"))
        marks = self.spark.createDataFrame([(p,) for p in touched], "part int").select(
            *[F.lit(None).cast(held.schema[n].dataType).alias(n) for n in LEAD_COLUMNS], "part")
        rows = change(held).select(*LEAD_COLUMNS, part.alias("part")).unionByName(marks)
        self._write(rows.hint("rebalance", "part"), "lead", "part")

    # -- logs -------------------------------------------------------------------

    def append(self, name: str, rows: DataFrame, run_id: str) -> None:
        """Add a run's rows, once: they are a partition of their own."""
        if not self.ended(run_id):
            self._write(rows.withColumn("run_id", F.lit(run_id)), name, "run_id")

    def erase_events(self, keep: Callable[[DataFrame], DataFrame], touched: DataFrame, run_id: str) -> None:
        """Rewrite the partitions of the runs in ``touched`` (run_id) without what ``keep`` leaves out."""
        if self.ended(run_id):
            return
        runs = touched.select("run_id").distinct()
        events = self._table("audit_event", TABLES["audit_event"])
        kept = keep(events.filter("event_id is not null").join(runs, "run_id", "left_semi"))
        marks = runs.select(*[F.col(n) if n == "run_id" else F.lit(None).cast(events.schema[n].dataType).alias(n)
                              for n in events.columns])
        rows = kept.select(events.columns).unionByName(marks)
        self._write(rows.hint("rebalance", "run_id"), "audit_event", "run_id", **{"mapreduce.output.basename": "kept"})
