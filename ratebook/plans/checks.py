"""The declared data tests of all tables. All of them warn, none fails a job."""

from pyspark.sql import functions as F

from ..operators.quality import (
    Check,
    above_zero,
    accepted_values,
    not_null,
    relationship,
    rows_where,
    unique,
)
from .validation import AMENDMENT_TYPES, RATE_TYPES

# Fixed values.
CONTRACT_STATUSES = ("ACTIVE", "EXPIRED", "FUTURE")
PAYER_TYPES = ("COMMERCIAL", "GOVERNMENT", "HMO", "PPO", "EPO")

STAGING: list[Check] = [
    *unique("stg_contracts", "contract_id"),
    *not_null(
        "stg_contracts",
        "contract_id",
        "payer_id",
        "provider_npi",
        "effective_date",
        "termination_date",
    ),
    # The status is first known in the enriched table.
    accepted_values("int_contracts_enriched", "contract_status", CONTRACT_STATUSES),
    *unique("stg_rate_schedules", "rate_schedule_id"),
    *not_null("stg_rate_schedules", "rate_schedule_id", "contract_id", "rate_amount"),
    relationship("stg_rate_schedules", "contract_id", "stg_contracts", "contract_id"),
    above_zero("stg_rate_schedules", "rate_amount"),
    accepted_values("stg_rate_schedules", "rate_type", RATE_TYPES),
    *unique("stg_amendments", "amendment_key"),
    *not_null("stg_amendments", "amendment_key", "contract_id"),
    relationship("stg_amendments", "contract_id", "stg_contracts", "contract_id"),
    accepted_values("stg_amendments", "amendment_type", AMENDMENT_TYPES),
]

CORE: list[Check] = [
    *unique("dim_contract", "contract_key"),
    *not_null("dim_contract", "contract_key", "contract_id", "is_current"),
    *unique("dim_provider", "provider_key", "provider_npi"),
    *not_null("dim_provider", "provider_key", "provider_npi"),
    *unique("dim_payer", "payer_key", "payer_id"),
    *not_null("dim_payer", "payer_key", "payer_id"),
    *unique("dim_service", "service_key", "cpt_code"),
    *not_null("dim_service", "service_key", "cpt_code"),
    *unique("dim_date", "date_key", "full_date"),
    *not_null("dim_date", "date_key", "full_date"),
    *unique("fact_contracted_rates", "rate_key"),
    *not_null(
        "fact_contracted_rates",
        "rate_key",
        "contract_key",
        "provider_key",
        "payer_key",
        "rate_amount",
    ),
    relationship("fact_contracted_rates", "contract_key", "dim_contract", "contract_key"),
    relationship("fact_contracted_rates", "provider_key", "dim_provider", "provider_key"),
    relationship("fact_contracted_rates", "payer_key", "dim_payer", "payer_key"),
    above_zero("fact_contracted_rates", "rate_amount"),
]

SEEDS: list[Check] = [
    *unique("ref_payers", "payer_id"),
    *not_null("ref_payers", "payer_id", "payer_name"),
    accepted_values("ref_payers", "payer_type", PAYER_TYPES),
    *unique("ref_service_categories", "category_code"),
    *not_null("ref_service_categories", "category_code", "category_name"),
]


def hand_written() -> list[Check]:
    """Built on call: their predicates need a running session."""
    return [
        rows_where(
            "positive_rates", "fact_contracted_rates", "rate_amount", F.col("rate_amount") <= 0
        ),
        rows_where(
            "valid_contract_dates",
            "dim_contract",
            "termination_date",
            (F.col("termination_date") < F.col("effective_date")) & F.col("is_current"),
        ),
    ]


def all_checks() -> list[Check]:
    return [*STAGING, *CORE, *SEEDS, *hand_written()]
