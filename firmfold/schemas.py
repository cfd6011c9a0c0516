"""Table schemas. Lists are native arrays; JSON text exists only at the edges."""

from __future__ import annotations

# A parsed record before normalising.
RAW = {
    "legal_name": "string", "brand_name": "string", "email": "string", "phone": "string",
    "website": "string", "address": "string", "vat_number": "string",
    "registration_number": "string", "classification_text": "string",
    "categories": "array<string>", "is_personal_data": "boolean", "source": "string",
    "source_url": "string", "source_license": "string",
}
RAW_STRUCT = "struct<" + ",".join(f"{n}:{t}" for n, t in RAW.items()) + ">"

RAW_PAGES = "source string, region_id string, page int, body string, fetched_at timestamp"

# Position of a record in the order in which its batch arrived.
SEQ = "struct<source_ord:int,region_ord:int,page:int,pos:int>"

LEAD_INPUT_COLUMNS = [
    "legal_name", "brand_name", "email", "phone", "website", "domain", "address",
    "vat_number", "registration_number", "region_id", "categories", "classification_text",
    "source", "source_url", "source_license", "is_personal_data",
]

LEAD = """lead_id string, dedupe_key string, legal_name string, brand_name string,
  vat_number string, registration_number string, email string, phone string, website string,
  domain string, address string, region_id string, categories array<string>,
  classification_text string, source string, source_url string, source_license string,
  is_personal_data boolean, gdpr_basis string, quality_score int, lifecycle string,
  review_status string, review_note string, reviewed_at timestamp, collected_at timestamp,
  last_verified_at timestamp, tax_status string, debt_free boolean, employee_count int,
  nav_checked_at timestamp, contact_checked_at timestamp, places_checked_at timestamp"""

CRAWL_STATE = ("source string, region_id string, last_page int, total_seen bigint, "
               "last_run_at timestamp")
SUPPRESSION = "value string, kind string, reason string, created_at timestamp"
AUDIT_EVENT = ("event_id string, lead_id string, type string, meta string, "
               "created_at timestamp, run_id string")

TABLES = {"lead": LEAD, "crawl_state": CRAWL_STATE, "suppression": SUPPRESSION,
          "audit_event": AUDIT_EVENT}


def column_names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


LEAD_COLUMNS = column_names(LEAD)
