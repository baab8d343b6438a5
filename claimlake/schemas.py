"""Explicit schemas of sources, operational tables and outputs."""

from __future__ import annotations

MONEY = "decimal(18,2)"

# ---- raw feeds
FEE_CSV = "cpt_code string, modifier string, geo_region string, rate string, rate_type string, effective_date string, _corrupt_record string"
BACKFILL_CSV = "claim_id string, patient_id string, provider_npi string, payer_id string, date_of_service string, total_billed string, cpt_codes string, diagnosis_codes string"
CROSSWALK_CSV = "legacy_code string, standard_code string, source_system string"
FHIR_PATIENT = (
    "resourceType string, id string, identifier array<struct<type: struct<coding: array<struct<code: string>>>, value: string>>, "
    "name array<struct<use: string, family: string, given: array<string>>>, birthDate string, gender string, "
    "address array<struct<use: string, line: array<string>, city: string, state: string, postalCode: string>>, "
    "extension array<struct<url: string, valueString: string>>"
)
EOB = "source_file string, payer_id string, fields map<string, struct<value: string, confidence: double>>, avg_confidence double"
CONTRACT = "source_file string, payer_id string, provider_npi string, effective_date string, tables array<array<map<string, string>>>"

# ---- change data capture. Primary key of each tracked table, and the columns that events add.
PRIMARY_KEYS = {
    "claims": ["claim_id"],
    "claim_lines": ["line_id"],
    "remittances": ["remit_id"],
    "patients": ["patient_id"],
    "providers": ["npi"],
    "payers": ["payer_id"],
    "fee_schedule": ["id"],
    "disputes": ["dispute_id"],
    "cases": ["case_id"],
    "deadlines": ["deadline_id"],
    "evidence_artifacts": ["artifact_id"],
}
CDC_COLUMNS = ["_cdc_operation", "_cdc_timestamp", "_source_table", "_bronze_loaded_ts", "_source_file", "_cdc_seq"]

DLQ = "source string, entity_type string, error_category string, error_detail string, entity_id string, payload string, status string"

# Error categories of the dead-letter queue.
ERROR_CATEGORIES = ["parse_failure", "validation_failure", "transient_failure", "unmatched_reference"]
# Days from filing to each regulatory deadline.
DEADLINE_DAYS = {"open_negotiation": 30, "idr_initiation": 34, "evidence_submission": 44, "entity_selection": 37, "idr_decision": 64}
DEFAULT_DEADLINES = ["open_negotiation", "idr_initiation", "idr_decision"]
# Statuses a case may move to.
TRANSITIONS = {
    "open": ["in_review"],
    "in_review": ["negotiation", "closed"],
    "negotiation": ["idr_initiated", "closed"],
    "idr_initiated": ["idr_submitted", "closed"],
    "idr_submitted": ["decided", "closed"],
    "decided": ["closed"],
}
# Reason codes (CARC) that deny a claim, and categories of reason and group codes.
DENIAL_CODES = ["4", "16", "18", "29", "50", "96", "197", "204"]
CODE_CATEGORIES = {
    "1": "patient_resp",
    "2": "patient_resp",
    "3": "patient_resp",
    "4": "denial",
    "16": "denial",
    "18": "denial",
    "29": "denial",
    "45": "contractual",
    "50": "denial",
    "96": "denial",
    "97": "contractual",
    "197": "denial",
    "204": "denial",
    "CO": "contractual",
    "PR": "patient_resp",
    "OA": "informational",
    "CR": "informational",
}
OPEN_END = "9999-12-31"
