"""Raw contracts to clean, typed, flat tables."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import md5_key
from ..functions.text import tabs_to_spaces, text_date, upper_trim, varchar
from ..operators.ranking import row_numbers
from ..operators.skew import Hot

# Width of the text fields of a rate line and of an amendment.
RATE_TEXT = {
    "service_category": 100,
    "cpt_code": 20,
    "description": 500,
    "rate_type": 50,
    "effective_date": 50,
    "rate_unit": 20,
    "modifier": 20,
}
AMENDMENT_TEXT = {
    "amendment_id": 100,
    "amendment_date": 50,
    "description": 1000,
    "rate_changes": 2000,
}
DEFAULT_UNIT = "EACH"
DEFAULT_AMENDMENT_TYPE = "MODIFICATION"

CONTEXT = ("payer_id", "provider_npi", "contract_effective_date", "contract_termination_date")
RATE_FIELDS = (
    "service_category",
    "cpt_code",
    "description",
    "rate_type",
    "rate_amount",
    "rate_date_text",
    "rate_unit",
    "modifier",
)
AMENDMENT_FIELDS = ("amendment_date_text", "amendment_id", "description", "rate_changes")
NESTED = ("rate_schedules", "amendments")


def stg_contracts(raw: DataFrame, strict: bool = True) -> DataFrame:
    """One row per raw contract with an id."""
    nested = [c for c in NESTED if c in raw.columns]
    return raw.where(F.col("contract_id").isNotNull()).select(
        "contract_id",
        F.trim("payer_name").alias("payer_name"),
        upper_trim(F.col("payer_id")).alias("payer_id"),
        F.trim("provider_npi").alias("provider_npi"),
        tabs_to_spaces(F.col("provider_name")).alias("provider_name"),
        text_date(F.col("effective_date"), strict).alias("effective_date"),
        text_date(F.col("termination_date"), strict).alias("termination_date"),
        *nested,
        F.col("extraction_metadata.extracted_at").alias("extracted_at"),
        F.col("extraction_metadata.confidence_score").cast("decimal(5,4)").alias("confidence_score"),
        F.col("extraction_metadata.source_file").alias("source_file"),
        "loaded_at",
        F.current_timestamp().alias("_dbt_loaded_at"),
    )


def _context(contracts: DataFrame) -> list[Column]:
    return [
        F.col("contract_id"),
        F.col("payer_id"),
        F.col("provider_npi"),
        F.col("effective_date").alias("contract_effective_date"),
        F.col("termination_date").alias("contract_termination_date"),
    ]


def rate_fields(get: Callable[[str], Column]) -> list[Column]:
    """Typed fields of a rate line, in RATE_FIELDS order."""
    text = {name: varchar(get(name), width) for name, width in RATE_TEXT.items()}
    text["rate_date_text"] = text.pop("effective_date")
    text["rate_amount"] = get("rate_amount").cast("decimal(12,2)")
    return [text[name].alias(name) for name in RATE_FIELDS]


def amendment_fields(get: Callable[[str], Column]) -> list[Column]:
    text = {name: varchar(get(name), width) for name, width in AMENDMENT_TEXT.items()}
    text["amendment_date_text"] = text.pop("amendment_date")
    return [text[name].alias(name) for name in AMENDMENT_FIELDS]


def rate_lines(contracts: DataFrame) -> DataFrame:
    """Unnest `rate_schedules`: one row per element, NULL and empty arrays give none."""
    lines = contracts.select(*_context(contracts), F.explode("rate_schedules").alias("line"))
    return lines.select(
        "contract_id", *CONTEXT, *rate_fields(lambda name: F.col(f"line.{name}"))
    )


def amendment_lines(contracts: DataFrame) -> DataFrame:
    """Unnest `amendments`."""
    lines = contracts.select(*_context(contracts), F.explode("amendments").alias("line"))
    return lines.select(
        "contract_id", *CONTEXT, *amendment_fields(lambda name: F.col(f"line.{name}"))
    )


def _sorted_elements(array: str, fields, names: Sequence[str], keep=None) -> Column:
    """Typed elements of an array in the order of `names`, NULLs last."""

    def sortable(element: Column) -> Column:
        typed = fields(lambda name: element.getField(name))
        parts = []
        for name, value in zip(names, typed):
            parts += [value.isNull().alias(f"no_{name}"), value]
        return F.struct(*parts)

    elements = F.transform(array, sortable)
    if keep is not None:
        elements = F.filter(elements, keep)
    return F.array_sort(elements)


def numbered_rates_of_unique_contracts(contracts: DataFrame, strict: bool = True) -> DataFrame:
    """`stg_rate_schedules` without a shuffle.

    Only when no contract id repeats: then all lines of a contract sit in one
    array, and the line number is the position in the sorted array.
    """
    ordered = _sorted_elements(
        "rate_schedules", rate_fields, RATE_FIELDS, lambda e: e.getField("rate_amount") > 0
    )
    lines = contracts.select(*_context(contracts), F.posexplode(ordered).alias("pos", "line"))
    return _rate_columns(
        lines.select(
            "contract_id",
            *CONTEXT,
            *[F.col(f"line.{name}") for name in RATE_FIELDS],
            (F.col("pos") + 1).cast("bigint").alias("rate_line_number"),
        ),
        strict,
    )


def numbered_amendments_of_unique_contracts(contracts: DataFrame, strict: bool = True) -> DataFrame:
    """`stg_amendments` without a shuffle, for contract ids that do not repeat."""
    ordered = _sorted_elements("amendments", amendment_fields, AMENDMENT_FIELDS)
    lines = contracts.select(*_context(contracts), F.posexplode(ordered).alias("pos", "line"))
    return _amendment_columns(
        lines.select(
            "contract_id",
            *CONTEXT,
            *[F.col(f"line.{name}") for name in AMENDMENT_FIELDS],
            (F.col("pos") + 1).cast("bigint").alias("amendment_sequence"),
        ),
        strict,
    )


def stg_rate_schedules(
    lines: DataFrame, hot: Hot | None = None, strict: bool = True
) -> DataFrame:
    """Rate lines with a positive amount, numbered per contract.

    The order is (service_category, cpt_code) as received; the remaining fields
    break ties, so keys do not depend on partitioning. `hot` lists contract ids
    with too many lines for one task.
    """
    order = [*RATE_FIELDS, *CONTEXT]
    positive = lines.where(F.col("rate_amount") > 0)
    return _rate_columns(
        row_numbers(positive, "contract_id", order, "rate_line_number", hot), strict
    )


def _rate_columns(numbered: DataFrame, strict: bool) -> DataFrame:
    key = F.concat(
        F.col("contract_id"),
        F.lit("-"),
        F.coalesce("cpt_code", F.lit("")),
        F.lit("-"),
        F.coalesce("service_category", F.lit("")),
        F.lit("-"),
        F.col("rate_line_number").cast("string"),
    )
    return numbered.select(
        md5_key(key).alias("rate_schedule_id"),
        "contract_id",
        "payer_id",
        "provider_npi",
        "rate_line_number",
        upper_trim(F.col("service_category")).alias("service_category"),
        F.trim("cpt_code").alias("cpt_code"),
        F.trim("description").alias("description"),
        upper_trim(F.col("rate_type")).alias("rate_type"),
        "rate_amount",
        text_date(F.col("rate_date_text"), strict, F.col("contract_effective_date")).alias(
            "rate_effective_date"
        ),
        upper_trim(F.coalesce("rate_unit", F.lit(DEFAULT_UNIT))).alias("rate_unit"),
        F.trim("modifier").alias("rate_modifier"),
        "contract_effective_date",
        "contract_termination_date",
        F.current_timestamp().alias("_loaded_at"),
    )


def stg_amendments(lines: DataFrame, hot: Hot | None = None, strict: bool = True) -> DataFrame:
    """Amendments numbered per contract by the date text, ties broken as above."""
    order = [*AMENDMENT_FIELDS, *CONTEXT]
    return _amendment_columns(
        row_numbers(lines, "contract_id", order, "amendment_sequence", hot), strict
    )


def _amendment_columns(numbered: DataFrame, strict: bool) -> DataFrame:
    number = F.col("amendment_sequence").cast("string")
    dash = F.lit("-")
    key = F.concat("contract_id", dash, F.coalesce("amendment_id", F.lit("")), dash, number)
    generated = F.concat(F.lit("AMD-"), "contract_id", dash, number)
    return numbered.select(
        md5_key(key).alias("amendment_key"),
        "contract_id",
        "payer_id",
        "provider_npi",
        F.coalesce(F.trim("amendment_id"), generated).alias("amendment_id"),
        "amendment_sequence",
        text_date(F.col("amendment_date_text"), strict).alias("amendment_effective_date"),
        F.trim("description").alias("amendment_description"),
        F.lit(DEFAULT_AMENDMENT_TYPE).alias("amendment_type"),
        F.trim("rate_changes").alias("amendment_changes"),
        "contract_effective_date",
        F.current_timestamp().alias("_loaded_at"),
    )
