"""Star schema: five dimensions and the fact."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import md5_key, packed_key, surrogate_key, unpacked_key
from ..functions.status import as_of_column, dated_status, open_ended_status
from ..operators.skew import Hot, is_small, lookup_join, repeat_rows, salted_join
from ..operators.storage import stored
from ..sources.tables import dealt
from .intermediate import with_category_names


def dim_contract(enriched: DataFrame) -> DataFrame:
    """One row per contract row; history lives in `contract_history`."""
    return enriched.select(
        md5_key(F.col("contract_id")).alias("contract_key"),
        "contract_id",
        "payer_id",
        "payer_name",
        "provider_npi",
        "provider_name",
        "effective_date",
        "termination_date",
        "contract_duration_days",
        "contract_status",
        "rate_schedule_count",
        "amendment_count",
        "last_amendment_date",
        "avg_rate_amount",
        "confidence_score",
        "source_file",
        "extracted_at",
        F.lit("1900-01-01").cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version_number"),
        F.current_timestamp().alias("_created_at"),
    )


def _contracts(unique_ids: bool) -> Column:
    return F.count("contract_id") if unique_ids else F.countDistinct("contract_id")


def dim_payer(
    contracts: DataFrame,
    ref_payers: DataFrame | None = None,
    as_of: date | None = None,
    dedupe: bool = False,
    unique_ids: bool = False,
) -> DataFrame:
    """One row per payer id and name; with `dedupe` the first name per id.

    `unique_ids`: contract ids are known to be there once, so rows are counted instead of ids.
    """
    known = contracts.where(F.col("payer_id").isNotNull())
    payers = known.select("payer_id", "payer_name").distinct()
    if dedupe:
        payers = payers.groupBy("payer_id").agg(F.min("payer_name").alias("payer_name"))
    stats = known.groupBy("payer_id").agg(
        _contracts(unique_ids).alias("total_contracts"),
        F.countDistinct("provider_npi").alias("contracted_providers"),
        F.min("effective_date").alias("first_contract_date"),
        F.max("termination_date").alias("latest_contract_end"),
    )
    joined = payers.join(stats, "payer_id", "left")
    if ref_payers is None:
        joined = joined.select(
            "*",
            *[
                F.lit(None).cast("string").alias(c)
                for c in ("payer_type", "payer_state", "payer_website")
            ],
        )
    else:
        attributes = ref_payers.select("payer_id", "payer_type", "payer_state", "payer_website")
        joined = lookup_join(joined, attributes, "payer_id", "left")
    return joined.select(
        md5_key(F.col("payer_id")).alias("payer_key"),
        "payer_id",
        "payer_name",
        "payer_type",
        "payer_state",
        "payer_website",
        F.coalesce("total_contracts", F.lit(0)).alias("total_contracts"),
        F.coalesce("contracted_providers", F.lit(0)).alias("contracted_providers"),
        "first_contract_date",
        "latest_contract_end",
        open_ended_status(F.col("latest_contract_end"), as_of_column(as_of)).alias("payer_status"),
        F.current_timestamp().alias("_created_at"),
    )


def dim_provider(
    contracts: DataFrame, as_of: date | None = None, unique_ids: bool = False
) -> DataFrame:
    """One row per NPI with the alphabetically first name.

    `min` gives the same name as a row number would. It is taken from the distinct names, apart
    from the statistics: beside a minimum of texts Spark sorts all rows to combine them.
    `unique_ids`: contract ids are known to be there once, so rows are counted instead of ids.
    """
    known = contracts.where(F.col("provider_npi").isNotNull())
    names = known.select("provider_npi", "provider_name").distinct()
    stats = known.groupBy("provider_npi").agg(
        _contracts(unique_ids).alias("total_contracts"),
        F.countDistinct("payer_id").alias("unique_payers"),
        F.min("effective_date").alias("first_contract_date"),
        F.max("termination_date").alias("latest_contract_end"),
    )
    providers = stats.join(
        names.groupBy("provider_npi").agg(F.min("provider_name").alias("provider_name")),
        "provider_npi",
    )
    return providers.select(
        surrogate_key(F.col("provider_npi")).alias("provider_key"),
        "provider_npi",
        "provider_name",
        "total_contracts",
        "unique_payers",
        "first_contract_date",
        "latest_contract_end",
        dated_status(F.col("latest_contract_end"), as_of_column(as_of)).alias("provider_status"),
        F.current_timestamp().alias("_created_at"),
    )


def dim_service(
    rates: DataFrame, ref_categories: DataFrame | None = None, dedupe: bool = False
) -> DataFrame:
    """One row per procedure code and category; with `dedupe` the first category per code."""
    known = rates.where(F.col("cpt_code").isNotNull())
    services = known.select("service_category", "cpt_code").distinct()
    if dedupe:
        services = services.groupBy("cpt_code").agg(
            F.min("service_category").alias("service_category")
        )
    stats = known.groupBy("cpt_code").agg(
        F.countDistinct("contract_id").alias("contracts_with_service"),
        F.countDistinct("provider_npi").alias("providers_offering"),
        F.min("rate_amount").alias("min_rate"),
        F.max("rate_amount").alias("max_rate"),
        F.avg("rate_amount").alias("avg_rate"),
    )
    joined = services.join(stats, "cpt_code", "left")
    if ref_categories is None:
        joined = joined.select(
            "*",
            F.col("service_category").alias("category_name"),
            F.lit(None).cast("string").alias("category_description"),
        )
    else:
        joined = with_category_names(
            joined,
            ref_categories,
            "service_category",
            {"category_name": "category_name", "description": "category_description"},
        )
    return joined.select(
        md5_key(F.col("cpt_code")).alias("service_key"),
        "cpt_code",
        F.col("service_category").alias("category_code"),
        "category_name",
        "category_description",
        F.coalesce("contracts_with_service", F.lit(0)).alias("contracts_with_service"),
        F.coalesce("providers_offering", F.lit(0)).alias("providers_offering"),
        "min_rate",
        "max_rate",
        "avg_rate",
        F.current_timestamp().alias("_created_at"),
    )


def calendar(days: DataFrame, as_of: date | None = None) -> DataFrame:
    """Date dimension columns for a table of `full_date`."""
    today = as_of_column(as_of)
    day = F.col("full_date")
    weekday = F.dayofweek(day) - 1
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.rpad(F.date_format(day, "MMMM"), 9, " ").alias("month_name"),
        F.date_format(day, "MMM").alias("month_abbr"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.rpad(F.date_format(day, "EEEE"), 9, " ").alias("day_name"),
        F.date_format(day, "EEE").alias("day_abbr"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.concat(F.date_format(day, "yyyy"), F.lit("-Q"), F.quarter(day).cast("string")).alias(
            "year_quarter"
        ),
        (day == today).alias("is_today"),
        (day == F.date_sub(today, 1)).alias("is_yesterday"),
        (F.trunc(day, "month") == F.trunc(today, "month")).alias("is_current_month"),
        (F.trunc(day, "year") == F.trunc(today, "year")).alias("is_current_year"),
    )


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Every day from the smallest `first` to the largest `last`, both included."""
    ends = bounds.agg(F.min(first).alias("first"), F.max(last).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("full_date"))


def dim_date(spark, first: date, last: date, as_of: date | None = None) -> DataFrame:
    """Calendar from `first` to `last`, both included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("full_date"))
    return calendar(days, as_of)


def _listed_services(services: DataFrame, rates: DataFrame) -> DataFrame:
    """cpt_code, service_key of the codes of the rates that do not have one row with the code's md5.

    These are codes of several rows, of no row, or with other keys. Only codes are shuffled, each once
    per task, in place of lines.
    """
    own = F.bool_and(F.col("service_key").eqNullSafe(md5_key(F.col("cpt_code"))))
    counted = services.groupBy("cpt_code").agg(F.count(F.lit(1)).alias("_rows"), own.alias("_own"))
    codes = rates.select("cpt_code").where("cpt_code IS NOT NULL").distinct()
    unusual = codes.join(counted.where("_rows = 1 AND _own"), "cpt_code", "left_anti")
    listed = unusual.join(services, "cpt_code", "left")
    return listed.select("service_key", "cpt_code", F.lit(True).alias("_listed"))


def fact_contracted_rates(
    rates: DataFrame,
    providers: DataFrame,
    payers: DataFrame,
    services: DataFrame,
    dates: DataFrame,
    contracts: DataFrame | None = None,
    hot: Hot | None = None,
    buckets: int = 0,
) -> DataFrame:
    """One row per rate line and matching dimension rows.

    Pass stored dimensions: their size decides between broadcast and shuffle.
    Leave `contracts` (`dim_contract`) out when contract ids are known to be
    unique; the contract key is then computed on the line.

    What is shuffled is a line without keys, as these do not compress: dimensions that are not
    broadcast come first, then rows are dealt to the `buckets` of a table by contract, if asked for.
    Of services that are not broadcast only the codes are joined whose key is not simply their md5.
    """
    lines = rates
    if contracts is not None:
        current = (
            contracts.where("is_current")
            .groupBy("contract_id", "contract_key")
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        lines = salted_join(lines, current, "contract_id", "inner", hot)
        lines = repeat_rows(lines, "_rows", "_row").drop("_rows", "_row")

    starts = dates.select(
        F.col("full_date").alias("rate_effective_date"),
        F.col("date_key").alias("effective_date_key"),
    )
    ends = dates.select(
        F.col("full_date").alias("contract_termination_date"),
        F.col("date_key").alias("termination_date_key"),
    )
    services = services.select("service_key", "cpt_code")
    listed = not is_small(services)
    if listed:
        services = stored(_listed_services(services, rates), "listed_services")
    lookups = (
        (payers.select("payer_key", "payer_id"), "payer_id", "inner"),
        (starts, "rate_effective_date", "left"),
        (ends, "contract_termination_date", "left"),
        (providers.select("provider_key", "provider_npi"), "provider_npi", "inner"),
        (services, "cpt_code", "left"),
    )
    large = [lookup for lookup in lookups if not is_small(lookup[0])]
    packed = bool(large or buckets)
    if packed:
        lines = lines.withColumn("rate_schedule_id", packed_key(F.col("rate_schedule_id")))
    for table, key, how in large:
        lines = lookup_join(lines, table, key, how, counted=rates)
    contract_key = md5_key(F.col("contract_id")) if contracts is None else F.col("contract_key")
    if buckets:
        lines = dealt(lines, buckets, contract_key)
    lines = lines.withColumn("contract_key", contract_key)
    if packed:
        lines = lines.withColumn("rate_schedule_id", unpacked_key(F.col("rate_schedule_id")))
    rate_key = md5_key(F.concat("rate_schedule_id", F.lit("-"), "contract_key"))
    lines = lines.withColumn("rate_key", rate_key)  # once for all rows that a line becomes
    for table, key, how in lookups:
        if not any(table is other for other, *_ in large):
            lines = lookup_join(lines, table, key, how, counted=rates)
    if listed:
        key = F.when(F.col("_listed"), F.col("service_key")).otherwise(md5_key(F.col("cpt_code")))
        lines = lines.withColumn("service_key", key)
    return lines.select(
        "rate_key",
        "contract_key",
        "provider_key",
        "payer_key",
        "service_key",
        "effective_date_key",
        "termination_date_key",
        "rate_schedule_id",
        "contract_id",
        "rate_line_number",
        "cpt_code",
        "rate_amount",
        "normalized_rate",
        "rate_type",
        "rate_unit",
        "rate_modifier",
        "service_category",
        "service_category_name",
        "rate_status",
        "contract_status",
        "rate_effective_date",
        "contract_effective_date",
        "contract_termination_date",
        "_loaded_at",
        F.current_timestamp().alias("_created_at"),
    )
