"""Row-level judgements: completeness score, cautions, retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmfold.functions.identity import is_valid_hu_vat, is_valid_reg_number
from firmfold.functions.text import has_text

LOW_QUALITY = 40
DAY_MILLIS = 86_400_000

# The texts that exports and reviewers get.
PERSONAL = "personal data — handle conservatively, likely exclude from early outreach"
NO_CHANNEL = "no contact channel"
UNCATEGORISED = "uncategorized"
LOW = f"low quality (<{LOW_QUALITY})"
TAX_CANCELLED = "tax number cancelled"
TAX_SUSPENDED = "tax number suspended"
TAX_DEBT = "has tax debt (not köztartozásmentes)"


def _points(condition: Column, points: int) -> Column:
    return F.when(condition, F.lit(points)).otherwise(F.lit(0))


def quality_score(email: Column, phone: Column, website: Column, domain: Column, address: Column,
                  region: Column, categories: Column, vat: Column, reg: Column) -> Column:
    """0 to 100: reachability first, then location, category and identity."""
    identity = (F.when(is_valid_hu_vat(vat), F.lit(15))
                .when(is_valid_reg_number(reg), F.lit(10)).otherwise(F.lit(0)))
    parts = [
        _points(has_text(email), 30),
        _points(has_text(phone), 10),
        _points(has_text(website) | has_text(domain), 10),
        _points(has_text(address), 10),
        _points(has_text(region), 10),
        _points(F.coalesce(F.size(categories), F.lit(0)) > 0, 15),
        identity,
    ]
    return F.least(F.lit(100), reduce(lambda a, b: a + b, parts)).cast("int")


def score_of_row() -> Column:
    """The score over a frame with the lead's column names."""
    c = F.col
    return quality_score(c("email"), c("phone"), c("website"), c("domain"), c("address"),
                         c("region_id"), c("categories"), c("vat_number"), c("registration_number"))


def _texts(candidates: list[Column]) -> Column:
    return F.array_except(F.array(*candidates), F.array(F.lit(None).cast("string")))


def review_reasons(email: Column, phone: Column, categories: Column, score: Column,
                   personal: Column) -> Column:
    """Why a record needs a careful look, weightiest first; empty = clean."""
    return _texts([
        F.when(personal, F.lit(PERSONAL)),
        F.when(~has_text(email) & ~has_text(phone), F.lit(NO_CHANNEL)),
        F.when(F.coalesce(F.size(categories), F.lit(0)) == 0, F.lit(UNCATEGORISED)),
        F.when(score < LOW_QUALITY, F.lit(LOW)),
    ])


def tax_risk_reasons(status: Column, debt_free: Column) -> Column:
    """Cautions from the tax office; an unknown debt status is not one."""
    return _texts([
        F.when(status == "CANCELLED", F.lit(TAX_CANCELLED)),
        F.when(status == "SUSPENDED", F.lit(TAX_SUSPENDED)),
        F.when(~debt_free, F.lit(TAX_DEBT)),
    ])


def age_days(collected_at: Column, now: Column) -> Column:
    """Age in fractional days, to the millisecond."""
    return (F.unix_millis(now) - F.unix_millis(collected_at)) / F.lit(DAY_MILLIS)


def purge_decision(suppressed: Column, personal: Column, lifecycle: Column, collected_at: Column,
                   now: Column, retention_days: int) -> Column:
    """SUPPRESSED, PERSONAL_DATA_EXPIRED, or null to keep the record."""
    expired = personal & (lifecycle == "NEW") & (age_days(collected_at, now) >= retention_days)
    return (F.when(suppressed, F.lit("SUPPRESSED"))
            .when(expired, F.lit("PERSONAL_DATA_EXPIRED")))
