"""Row numbers per key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import Hot, hot_rows, hot_table, repeat_rows, slices_for
from .storage import stored


def _ascending(columns: Sequence[str]) -> list:
    return [F.col(c).asc_nulls_last() for c in columns]


def row_numbers(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    out: str,
    hot: Hot | None = None,
    slices: int | None = None,
) -> DataFrame:
    """`row_number()` per `key`, ascending, NULLs last.

    Keys listed in `hot` have too many rows for one task: they are numbered
    over range slices, as many as their rows ask for. All others use the window.
    """
    window = Window.partitionBy(key).orderBy(*_ascending(order))
    number = F.row_number().over(window).cast("bigint")
    if not hot:
        return df.withColumn(out, number)
    marks = hot_table(df, key, hot).select(key)
    slices = slices or max(
        slices_for(hot_rows(hot)),
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
    usual = df.join(marks, key, "left_anti").withColumn(out, number)
    return usual.unionByName(
        _sliced_numbers(df.join(marks, key, "left_semi"), key, order, out, slices)
    )


def _sliced_numbers(df, key, order, out, slices):
    """Number rows whose key spans many tasks.

    Exact copies are counted before the shuffle. The distinct rows are cut
    into ranges of (key, order) and stored, because the cut points come from a
    sample and must not change between the two passes: one pass counts the rows
    of each key per slice (few rows: slices + keys), the other numbers the
    rows inside a slice and adds the count of the slices before it.
    """
    columns = df.columns
    rest = [c for c in columns if c != key and c not in order]
    order = list(order) + rest

    distinct = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    ranged = distinct.repartitionByRange(slices, key, *_ascending(order))
    ranged = stored(ranged.withColumn("_slice", F.spark_partition_id()), "slices")

    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(key, "_slice")
        .agg(F.sum("_copies").alias("_rows"))
        .select(key, "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = (
        Window.partitionBy("_slice", key)
        .orderBy(*_ascending(order))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.withColumn("_inside", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(
        offsets, [key, "_slice"]
    )
    copies = repeat_rows(placed, "_copies", "_copy", slices)
    number = (F.col("_before") + F.col("_inside") + F.col("_copy")).cast("bigint")
    return copies.select(*columns, number.alias(out))
