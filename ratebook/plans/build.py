"""All tables of the star schema from the raw contracts."""

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import run_checks
from ..operators.skew import HOT_ROWS, Hot, hot_keys, is_small
from ..operators.storage import ROW_GROUP_BYTES, read_in_small_splits, stored, stored_all
from . import intermediate, marts, staging
from .checks import all_checks

# First and last day of the date dimension, which data outside of them widen.
FIRST_DAY = date(2020, 1, 1)
LAST_DAY = date(2030, 12, 30)


@dataclass(frozen=True)
class Staged:
    """Stored staging tables and what is known about their contract ids.

    `contracts` are the headers: their nested columns live on in the lines.
    `repeated` holds the contract ids of several rows, None if there are none.
    """

    contracts: DataFrame
    rates: DataFrame
    amendments: DataFrame
    repeated: DataFrame | None = None
    hot_rates: Hot = field(default_factory=dict)
    hot_contracts: Hot = field(default_factory=dict)


def repeated_contracts(contracts: DataFrame) -> DataFrame | None:
    """The contract ids of several rows, None if there are none. Reads the id column only."""
    many = contracts.groupBy("contract_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stored(many.select("contract_id"), "repeated_contracts")
    return None if repeated.isEmpty() else repeated


def split_by(df: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of contracts that are there once, and of the others; no shuffle if those are few."""
    ids = F.broadcast(repeated) if is_small(repeated) else repeated
    return df.join(ids, "contract_id", "left_anti"), df.join(ids, "contract_id", "left_semi")


def _lines_per_contract(contracts: DataFrame, array: str, element: str, min_rows: int) -> Hot:
    """Contracts with very many array elements; reads one field of the elements."""
    return hot_keys(
        contracts, "contract_id", F.greatest(F.size(f"{array}.{element}"), F.lit(0)), min_rows
    )


def latest_of_each(raw: DataFrame) -> DataFrame:
    """One row per contract: the one loaded last, of equal times the one with the greatest content.

    Combines before the shuffle, so each task sends a contract once, however often it was loaded.
    """
    last = F.struct("loaded_at", F.to_json(F.struct(*raw.columns)))
    row = F.max_by(F.struct(*raw.columns), last).alias("row")
    return raw.groupBy("contract_id").agg(row).select("row.*")


def stage(
    raw: DataFrame, strict: bool = True, min_hot_rows: int = HOT_ROWS, latest_load: bool = False
) -> Staged:
    """Staging tables from nested raw contracts.

    Every line of a contract that is there once is numbered inside its own row and
    nothing is shuffled. The lines of the other contracts meet in a window, and
    those too large for one task are numbered over slices. The nested
    columns are read where they are unnested and never copied.

    Contracts that were loaded several times multiply their lines, as joins on the id do. With
    `latest_load` only the row loaded last is used; the raw rows left are stored once.
    """
    read_in_small_splits(raw.sparkSession)
    if latest_load:
        raw = stored(latest_of_each(raw), "latest_contracts")
    contracts = staging.stg_contracts(raw, strict)
    headers = stored(contracts.drop(*staging.NESTED), "stg_contracts")
    repeated = repeated_contracts(headers)
    usual, again = (contracts, None) if repeated is None else split_by(contracts, repeated)
    rates = staging.numbered_rates_of_unique_contracts(usual, strict)
    amendments = staging.numbered_amendments_of_unique_contracts(usual, strict)
    hot_rates, hot_contracts = {}, {}
    if again is not None:
        hot_contracts = hot_keys(headers, "contract_id", min_rows=min_hot_rows)
        hot_rates = _lines_per_contract(again, "rate_schedules", "cpt_code", min_hot_rows)
        hot_amendments = _lines_per_contract(again, "amendments", "amendment_id", min_hot_rows)
        rates = rates.unionByName(
            staging.stg_rate_schedules(staging.rate_lines(again), hot_rates, strict)
        )
        amendments = amendments.unionByName(
            staging.stg_amendments(staging.amendment_lines(again), hot_amendments, strict)
        )
    lines = stored_all(
        {"stg_rate_schedules": rates, "stg_amendments": amendments}, ROW_GROUP_BYTES
    )
    return Staged(
        headers,
        lines["stg_rate_schedules"],
        lines["stg_amendments"],
        repeated,
        hot_rates,
        hot_contracts,
    )


def covered_days(staged: Staged) -> tuple[date, date]:
    """First and last day of the calendar, or of any date of the contracts and their rates beyond it.

    So each date finds its key.

    One job per table that reads the date columns only and brings one row to the driver.
    """
    found = [FIRST_DAY, LAST_DAY]
    for table, names in (
        (staged.contracts, ("effective_date", "termination_date")),
        (staged.rates, ("rate_effective_date",)),
    ):
        ends = [f(F.col(c)) for c in names for f in (F.min, F.max)]
        found += [d for d in table.agg(*ends).first() if d is not None]
    return min(found), max(found)


def normalized_rates(
    staged: Staged,
    enriched: DataFrame | None,
    ref_categories: DataFrame | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """Normalised rates; `enriched` is only needed when contract ids repeat."""

    def normalized(rates: DataFrame, contracts: DataFrame | None) -> DataFrame:
        return intermediate.int_rates_normalized(
            rates, contracts, ref_categories, as_of, staged.hot_rates
        )

    if staged.repeated is None:
        return normalized(staged.rates, None)
    usual, again = split_by(staged.rates, staged.repeated)
    return normalized(usual, None).unionByName(
        normalized(again, split_by(enriched, staged.repeated)[1])
    )


def fact_table(
    staged: Staged, rates: DataFrame, dimensions: dict[str, DataFrame], buckets: int = 0
) -> DataFrame:
    """The fact; `dim_contract` is only needed when contract ids repeat.

    With `buckets` its rows are dealt for a table of so many buckets by contract key.
    """
    lookups = [dimensions[f"dim_{name}"] for name in ("provider", "payer", "service", "date")]

    def fact(lines: DataFrame, contracts: DataFrame | None) -> DataFrame:
        return marts.fact_contracted_rates(
            lines, *lookups, contracts, staged.hot_rates, buckets
        )

    if staged.repeated is None:
        return fact(rates, None)
    usual, again = split_by(rates, staged.repeated)
    return fact(usual, None).unionByName(
        fact(again, split_by(dimensions["dim_contract"], staged.repeated)[1])
    )


def build(
    staged: Staged,
    as_of: date | None = None,
    ref_payers: DataFrame | None = None,
    ref_categories: DataFrame | None = None,
    days: tuple[date, date] | None = None,
) -> dict[str, DataFrame]:
    """Intermediate and mart tables by name; dimensions are stored, the fact is lazy.

    `days`: first and last day of the date dimension, by default `covered_days`.
    """
    spark = staged.contracts.sparkSession
    read_in_small_splits(spark)
    unique_ids = staged.repeated is None
    first_day, last_day = days or covered_days(staged)
    first = stored_all(
        {
            "int_contracts_enriched": intermediate.int_contracts_enriched(
                staged.contracts, staged.rates, staged.amendments, as_of, staged.hot_contracts
            ),
            "dim_payer": marts.dim_payer(
                staged.contracts, ref_payers, as_of, unique_ids=unique_ids
            ),
            "dim_provider": marts.dim_provider(staged.contracts, as_of, unique_ids),
            "dim_service": marts.dim_service(staged.rates, ref_categories),
            "dim_date": marts.dim_date(spark, first_day, last_day, as_of),
        }
    )
    enriched = first.pop("int_contracts_enriched")
    dimensions = {"dim_contract": stored(marts.dim_contract(enriched), "dim_contract"), **first}
    rates = normalized_rates(staged, enriched, ref_categories, as_of)
    fact = fact_table(staged, rates, dimensions)
    return {
        "stg_contracts": staged.contracts,
        "stg_rate_schedules": staged.rates,
        "stg_amendments": staged.amendments,
        "int_contracts_enriched": enriched,
        "int_rates_normalized": rates,
        **dimensions,
        "fact_contracted_rates": fact,
    }


def quality_report(
    tables: dict[str, DataFrame], ref_payers: DataFrame, ref_categories: DataFrame
) -> DataFrame:
    """Result of all declared data tests over the tables of `build`."""
    fact = stored(tables["fact_contracted_rates"], "fact_contracted_rates", ROW_GROUP_BYTES)
    known = {
        **tables,
        "fact_contracted_rates": fact,
        "ref_payers": ref_payers,
        "ref_service_categories": ref_categories,
    }
    return run_checks(known, all_checks())
