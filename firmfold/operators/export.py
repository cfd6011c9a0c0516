"""Export of the master table as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from firmfold.operators.review import top_quality

# Names and order of the exported fields.
EXPORT_FIELDS = {
    "externalId": "lead_id", "legalName": "legal_name", "vatNumber": "vat_number",
    "registrationNumber": "registration_number", "regionId": "region_id",
    "categories": "categories", "email": "email", "phone": "phone", "website": "website",
    "qualityScore": "quality_score", "taxStatus": "tax_status", "debtFree": "debt_free",
    "source": "source",
}


def export_filter(lead: DataFrame, min_quality: int = 0, approved_only: bool = False,
                  include_personal: bool = False) -> DataFrame:
    rows = lead.filter(F.col("quality_score") >= min_quality)
    rows = rows.filter("review_status = 'APPROVED'" if approved_only else "review_status <> 'REJECTED'")
    return rows if include_personal else rows.filter(~F.col("is_personal_data"))


def export_record(lead: DataFrame) -> DataFrame:
    return lead.select(*[F.col(c).alias(n) for n, c in EXPORT_FIELDS.items()])


def export_ndjson(lead: DataFrame, path: str, min_quality: int = 0, approved_only: bool = False,
                  include_personal: bool = False) -> None:
    """Best first, in part files whose names follow the order. Nulls are written."""
    rows = export_filter(lead, min_quality, approved_only, include_personal)
    (export_record(rows.orderBy(*top_quality()))
     .write.mode("overwrite").option("ignoreNullFields", "false").json(path))


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """(line, record): an export's lines in their order, numbered from 1.

    The sort's ranges are files in the order of their numbers. A line's number is its place
    in its file and the lines of the files before it: only one row per file is summed in
    one task, lines are numbered file by file.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("record"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("int")
    before = Window.orderBy("number", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n")).withColumn("number", number).select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("file").orderBy("block", "at"))
    return lines.withColumn("inside", inside).join(files, "file").select(
        (F.col("before") + F.col("inside")).alias("line"), "record")
