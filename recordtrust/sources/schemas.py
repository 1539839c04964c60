"""Declared schemas of the relations the pipeline reads.

A ``None`` type keeps whatever type the source has: logo keys may be text or numbers.
"""

from __future__ import annotations

SCHEMAS: dict[str, dict[str, str | None]] = {
    "comp_version": {"id": "bigint", "submitter_person_id": "bigint", "comp_data_id": "bigint"},
    "comp_data": {
        "id": "bigint",
        "tenant_id": "bigint",
        "transaction_size": "double",
        "starting_rent": "double",
        "execution_date": "timestamp_ntz",
        "commencement_date": "timestamp_ntz",
        "lease_term": "double",
        "expiration_date": "timestamp_ntz",
        "work_value": "double",
        "free_months": "bigint",
        "transaction_type_id": "bigint",
        "rent_bumps_percent_bumps": "bigint",
        "rent_bumps_dollar_bumps": "bigint",
        "lease_type_id": "bigint",
    },
    "comp_master": {"id": "bigint", "comp_data_id": "bigint"},
    "comp_master_versions": {"comp_master_id": "bigint", "comp_version_id": "bigint"},
    "comp_proposal": {"comp_version_id": "bigint", "comp_batch_id": "bigint"},
    "lease_tasks": {"batch_id": "bigint", "submission_id": "bigint"},
    "submissions": {"id": "bigint"},
    "logo_detection_submission": {"id": "bigint", "logo": None},
    "tenant": {"id": "bigint", "name": "string"},
    "comp_data_calculated_fields": {"comp_data_id": "bigint", "space_type_id": "bigint"},
    "person": {"id": "bigint", "first_name": "string", "last_name": "string"},
}
