"""Helpers shared by the training-data operators."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmfold.session import SETTINGS, scratch_dir

# White space of the word rule `[^\x20\x09-\x0D]+`, as a character class.
SPACE = r"\x20\x09-\x0D"


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; adaptive execution splits hot join keys."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, SETTINGS[key])
    # Rows with whole texts are wide: keep the batches sent to Python small.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "32m")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write the frame to the shared folder and read it again."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate an array expression once and use it many times."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text as an array; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def pick(frame: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names.

    Whatever else the input holds, clashing names included, stays outside.
    """
    return frame.select(*[F.col(f"`{have}`").alias(own) for own, have in columns.items()])
