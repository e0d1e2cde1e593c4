"""Contracts with statistics and status; normalised rates."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.status import as_of_column, contract_status, normalized_rate, rate_status
from ..operators.skew import Hot, lookup_join, repeat_rows, salted_join


def rate_stats(rates: DataFrame) -> DataFrame:
    return rates.groupBy("contract_id").agg(
        F.count(F.lit(1)).alias("rate_schedule_count"),
        F.sum("rate_amount").alias("total_rate_value"),
        F.avg("rate_amount").alias("avg_rate_amount"),
        F.min("rate_amount").alias("min_rate_amount"),
        F.max("rate_amount").alias("max_rate_amount"),
    )


def amendment_stats(amendments: DataFrame) -> DataFrame:
    return amendments.groupBy("contract_id").agg(
        F.count(F.lit(1)).alias("amendment_count"),
        F.max("amendment_effective_date").alias("last_amendment_date"),
    )


def int_contracts_enriched(
    contracts: DataFrame,
    rates: DataFrame,
    amendments: DataFrame,
    as_of: date | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """Contracts with duration, status, rate and amendment statistics.

    `hot`: contract ids that very many rows of `contracts` share.
    """
    today = as_of_column(as_of)
    joined = salted_join(contracts, rate_stats(rates), "contract_id", "left", hot)
    joined = salted_join(joined, amendment_stats(amendments), "contract_id", "left", hot)
    effective, termination = F.col("effective_date"), F.col("termination_date")
    return joined.select(
        "contract_id",
        "payer_id",
        "payer_name",
        "provider_npi",
        "provider_name",
        "effective_date",
        "termination_date",
        F.datediff(F.coalesce(termination, today), effective)
        .cast("bigint")
        .alias("contract_duration_days"),
        contract_status(effective, termination, today).alias("contract_status"),
        F.coalesce("rate_schedule_count", F.lit(0)).alias("rate_schedule_count"),
        "total_rate_value",
        "avg_rate_amount",
        "min_rate_amount",
        "max_rate_amount",
        F.coalesce("amendment_count", F.lit(0)).alias("amendment_count"),
        "last_amendment_date",
        "confidence_score",
        "source_file",
        "extracted_at",
        "loaded_at",
        F.current_timestamp().alias("_enriched_at"),
    )


def with_category_names(
    df: DataFrame, ref_categories: DataFrame, category: str, names: dict[str, str]
) -> DataFrame:
    """Left join of the category reference, ignoring case; `names` maps its columns."""
    table = ref_categories.select(
        F.upper("category_code").alias("_code"),
        *[F.col(source).alias(target) for source, target in names.items()],
    )
    return lookup_join(df.withColumn("_code", F.upper(category)), table, "_code", "left").drop(
        "_code"
    )


def int_rates_normalized(
    rates: DataFrame,
    contracts: DataFrame | None = None,
    ref_categories: DataFrame | None = None,
    as_of: date | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """Rate lines with normalised rate, rate status and contract status.

    `contracts` is `int_contracts_enriched`: each line meets every contract row
    with its id. Those rows are counted per status before the join. Leave it
    out when contract ids are known to be unique: the status then follows from
    the dates on the line itself and nothing is shuffled.
    """
    today = as_of_column(as_of)
    start, end = F.col("contract_effective_date"), F.col("contract_termination_date")
    if contracts is None:
        joined = rates.withColumn("contract_status", contract_status(start, end, today))
    else:
        statuses = contracts.groupBy("contract_id", "contract_status").agg(
            F.count(F.lit(1)).alias("_rows")
        )
        joined = salted_join(rates, statuses, "contract_id", "left", hot)
        joined = repeat_rows(
            joined.withColumn("_rows", F.coalesce("_rows", F.lit(1))), "_rows", "_row"
        ).drop("_rows", "_row")
    name = F.col("service_category")
    if ref_categories is not None:
        joined = with_category_names(
            joined, ref_categories, "service_category", {"category_name": "_category_name"}
        )
        name = F.coalesce("_category_name", "service_category")
    return joined.select(
        "rate_schedule_id",
        "contract_id",
        "payer_id",
        "provider_npi",
        "rate_line_number",
        "service_category",
        name.alias("service_category_name"),
        "cpt_code",
        "description",
        "rate_type",
        "rate_amount",
        normalized_rate(F.col("rate_type"), F.col("rate_amount")).alias("normalized_rate"),
        "rate_effective_date",
        "rate_unit",
        "rate_modifier",
        "contract_effective_date",
        "contract_termination_date",
        rate_status(F.col("rate_effective_date"), end, today).alias("rate_status"),
        "contract_status",
        "_loaded_at",
    )
