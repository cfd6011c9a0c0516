"""Answers of the lookup services -> typed lookup tables.

Input: (key, body, fetched_at) with the JSON answer as text; the time may be
absent where a key has one answer. Output: one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmfold.functions.text import blank_to_null, collapse_blanks, js_trim

TAX_STATUSES = ["ACTIVE", "SUSPENDED", "CANCELLED", "UNKNOWN"]
UNDISCLOSED = "---"


def _disclosed(c: Column) -> Column:
    text = collapse_blanks(c)
    return F.when(~text.isin("", UNDISCLOSED), text)


def _text_at(doc: Column, *fields: str) -> list[Column]:
    """Members that are JSON strings; other types count as absent."""
    out = []
    for f in fields:
        node = F.try_variant_get(doc, f"$.{f}", "variant")
        out.append(F.when(F.schema_of_variant(node) == "STRING",
                          F.try_variant_get(doc, f"$.{f}", "string")))
    return out


def vat_register_answer(body: Column) -> Column:
    """Valid only where the answer says so literally."""
    doc = F.try_parse_json(body)
    valid_node = F.try_variant_get(doc, "$.valid", "variant")
    valid = (F.schema_of_variant(valid_node) == "BOOLEAN") & F.try_variant_get(doc, "$.valid", "boolean")
    name, address, date = _text_at(doc, "name", "address", "requestDate")
    return F.struct(F.coalesce(valid, F.lit(False)).alias("valid"),
                    _disclosed(name).alias("name"), _disclosed(address).alias("address"),
                    date.alias("request_date"))


def tax_answer(body: Column) -> Column:
    """Status, debt status (three-valued) and head count.

    An explicit null or blank head count is 0, a missing one unknown.
    """
    doc = F.try_parse_json(body)
    status = F.upper(js_trim(F.try_variant_get(doc, "$.taxStatus", "string")))
    debt_node = F.try_variant_get(doc, "$.debtFree", "variant")
    debt_free = F.when(F.schema_of_variant(debt_node) == "BOOLEAN",
                       F.try_variant_get(doc, "$.debtFree", "boolean"))
    count_node = F.try_variant_get(doc, "$.employeeCount", "variant")
    text = js_trim(F.try_variant_get(doc, "$.employeeCount", "string"))
    number = (F.when(F.is_variant_null(count_node) | text.isin("", "false"), F.lit(0.0))
              .when(text == "true", F.lit(1.0))
              .otherwise(text.try_cast("double")))
    usable = (number >= 0) & (number < 2147483648.0)
    return F.struct(
        F.when(status.isin(TAX_STATUSES), status).otherwise(F.lit("UNKNOWN")).alias("tax_status"),
        debt_free.alias("debt_free"),
        F.when(usable, F.floor(number).cast("int")).alias("employee_count"))


def place_answer(body: Column) -> Column:
    """Phone, website and address, under any of their spellings."""
    doc = F.try_parse_json(body)

    def first(*fields: str) -> Column:
        return F.coalesce(*[blank_to_null(t) for t in _text_at(doc, *fields)])

    return F.struct(
        first("phone", "formatted_phone_number", "internationalPhoneNumber").alias("phone"),
        first("website", "websiteUri").alias("website"),
        first("address", "formatted_address", "formattedAddress").alias("address"))


def _table(answers: DataFrame, key: str, answer: Column) -> DataFrame:
    """One answer per key: the one fetched last, of equal times the greater text.

    Copies meet in the partial aggregate. Answers without a time count as the oldest.
    """
    at = F.col("fetched_at") if "fetched_at" in answers.columns else F.lit(None).cast("timestamp")
    newest = F.max(F.struct(at.alias("at"), F.col("body"))).alias("newest")
    one = answers.groupBy(F.col("key").alias(key)).agg(newest).select(key, "newest.body")
    return one.select(key, answer.alias("a")).select(key, "a.*")


def parse_vat_register(answers: DataFrame) -> DataFrame:
    return _table(answers, "core", vat_register_answer(F.col("body")))


def parse_tax_signals(answers: DataFrame) -> DataFrame:
    return _table(answers, "core", tax_answer(F.col("body")))


def parse_places(answers: DataFrame) -> DataFrame:
    return _table(answers, "name", place_answer(F.col("body")))
