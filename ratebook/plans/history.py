"""History of the contracts."""

from datetime import datetime

from pyspark.sql import DataFrame

from ..operators.history import RANGES, apply_snapshot, merge_snapshot
from ..operators.skew import Hot

# Key and compared columns of the contract history.
KEY = "contract_id"
CHECKED = (
    "payer_id",
    "payer_name",
    "provider_npi",
    "provider_name",
    "effective_date",
    "termination_date",
    "contract_status",
)


def contract_history(
    history: DataFrame | None, enriched: DataFrame, at: datetime, hot: Hot | None = None
) -> DataFrame:
    """`enriched` is `int_contracts_enriched`, where the compared columns exist."""
    return apply_snapshot(history, _kept(enriched), KEY, CHECKED, at, hot)


def merge_contract_history(
    path: str, enriched: DataFrame, at: datetime, hot: Hot | None = None, ranges: int = RANGES
) -> None:
    """The same on a stored history, of which only the ranges of keys of this load are rewritten."""
    merge_snapshot(path, _kept(enriched), KEY, CHECKED, at, hot, ranges)


def _kept(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        KEY,
        *CHECKED,
        "contract_duration_days",
        "extracted_at",
        "confidence_score",
        "source_file",
        "loaded_at",
    )
