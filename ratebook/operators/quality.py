"""Declared data tests, run as one aggregate.

Each table is read once, whatever is tested in it. A row says, for every key check, which key it
has, and for every row check (not null, accepted values, ranges, predicates) that it fails it, if
it does. One aggregate counts these by check and key, combined before the shuffle, so that a task
sends one row per key whatever the skew; a second one adds up the failures of each check. Nothing
fails the job: the result is a report.
"""

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""
    failing: Column | None = field(default=None, compare=False)
    severity: str = "warn"


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", table, c) for c in columns]


def unique(table: str, *columns: str) -> list[Check]:
    return [Check("unique", table, c) for c in columns]


def accepted_values(table: str, column: str, values: Iterable[str]) -> Check:
    return Check("accepted_values", table, column, values=tuple(values))


def above_zero(table: str, column: str) -> Check:
    return Check("accepted_range", table, column)


def relationship(table: str, column: str, parent: str, parent_column: str) -> Check:
    return Check("relationships", table, column, parent=parent, parent_column=parent_column)


def rows_where(name: str, table: str, column: str, failing: Column) -> Check:
    """A hand-written test: the rows where `failing` holds."""
    return Check(name, table, column, failing=failing)


def _row_predicate(check: Check) -> Column:
    column = F.col(check.column)
    if check.failing is not None:
        return check.failing
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(*check.values)
    return ~(column > 0)


def _entry(check: int, key: Column, counts: bool, applies: Column) -> Column:
    """What a row says for a check: its key, and whether it counts or only makes the key known."""
    return F.struct(
        F.lit(check).alias("check"),
        key.cast("string").alias("key"),
        F.lit(int(counts)).cast("bigint").alias("rows"),
        F.lit(not counts).alias("known"),
        applies.alias("applies"),
    )


def _entries(table: str, checks: list[Check]) -> list[Column]:
    """What each row of a table says for the checks that read it."""
    found = []
    for i, check in enumerate(checks):
        key = F.col(check.column)
        if check.table == table and check.kind in ("unique", "relationships"):
            found.append(_entry(i, key, True, key.isNotNull()))
        elif check.table == table:
            found.append(_entry(i, F.lit(None), True, _row_predicate(check)))
        if check.kind == "relationships" and check.parent == table:
            key = F.col(check.parent_column)
            found.append(_entry(i, key, False, key.isNotNull()))
    return found


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """(test, table_name, column_name, failures, severity); pass stored tables."""
    checks = list(checks)
    said = None
    for name in dict.fromkeys(t for c in checks for t in (c.table, c.parent) if t):
        entries = F.array(*_entries(name, checks))
        own = tables[name].select(F.inline(entries)).where("applies").drop("applies")
        said = own if said is None else said.unionByName(own)
    counted = said.groupBy("check", "key").agg(
        F.sum("rows").alias("rows"), F.bool_or("known").alias("known")
    )

    def is_one_of(kind: str) -> Column:
        return F.col("check").isin(*[i for i, c in enumerate(checks) if c.kind == kind])

    failures = (
        F.when(is_one_of("unique"), (F.col("rows") > 1).cast("bigint"))
        .when(is_one_of("relationships"), F.when(F.col("known"), 0).otherwise(F.col("rows")))
        .otherwise(F.col("rows"))
    )
    failed = counted.groupBy("check").agg(F.sum(failures).alias("failures"))
    listed = said.sparkSession.createDataFrame(
        [(i, c.kind, c.table, c.column, c.severity) for i, c in enumerate(checks)],
        "check int, test string, table_name string, column_name string, severity string",
    )
    return listed.join(failed, "check", "left").select(
        "test",
        "table_name",
        "column_name",
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
        "severity",
    )
