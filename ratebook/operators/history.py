"""Type 2 history by comparing columns."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .skew import Hot, hot_table, salted_join
from .storage import stored

# Ranges of keys of a stored history; a load rewrites the open versions of those it has keys in.
RANGES = 256
_RANGE = "key_range"


def _version(key: str, at: Column) -> dict[str, Column]:
    """The columns of a version that opens at a time, but for its end."""
    stamp = F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    name = F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), stamp))
    return {"dbt_scd_id": name, "dbt_updated_at": at, "dbt_valid_from": at}


def _versions(rows: DataFrame, key: str, at: Column) -> DataFrame:
    made = [column.alias(name) for name, column in _version(key, at).items()]
    return rows.select("*", *made, F.lit(None).cast("timestamp").alias("dbt_valid_to"))


def apply_snapshot(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check: Sequence[str],
    at: datetime,
    hot: Hot | None = None,
) -> DataFrame:
    """History after comparing `current` with the open versions on the `check` columns.

    Rows are matched by key and the content of the check columns together, so
    a key may repeat: a pair without an open version gets one for each of its
    rows; an open version whose key is in `current` but whose pair is not is
    closed at `at`; everything else stays, keys missing from `current` too.
    Loading the same rows twice adds nothing. Rows without a key are always
    new. Write the result to a new path or table, never over the history it
    reads. `hot`: keys that very many rows share.
    """
    at = F.lit(at).cast("timestamp")
    if history is None:
        return _versions(current, key, at)
    return _compared(history, current, key, check, at, hot)


def _pair(key: str, check: Sequence[str]) -> Column:
    """Key and content of a row; NULL without a key."""
    content = F.to_json(F.struct(key, *check), {"ignoreNullFields": "false"})
    return F.when(F.col(key).isNotNull(), F.unhex(F.sha2(content, 256)))


def _compared(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check: Sequence[str],
    at: Column,
    hot: Hot | None,
    ranged: bool = False,
) -> DataFrame:
    """`apply_snapshot` by one shuffle of both sides; `ranged` leaves the rows in ranges of the key.

    Hot keys are compared by joins on the pair; rows without a key are compared with nothing.
    """
    has_key = F.col(key).isNotNull()
    old, new = history.where(has_key), current.where(has_key)
    if hot:
        marks = hot_table(current, key, hot).select(key)
        heavy = [rows.join(marks, key, "left_semi").select(rows.columns) for rows in (old, new)]
        old, new = (rows.join(marks, key, "left_anti").select(rows.columns) for rows in (old, new))
    found = _compared_by_key(old, new, key, check, at, ranged)
    if hot:
        found = found.unionByName(_compared_by_pair(*heavy, key, check, at, hot))
    alone = history.where(~has_key).unionByName(_versions(current.where(~has_key), key, at))
    return found.unionByName(alone).select(history.columns)


def _compared_by_key(
    old: DataFrame, new: DataFrame, key: str, check: Sequence[str], at: Column, ranged: bool
) -> DataFrame:
    """Rows of a key meet in one task, at any size of the table: whole rows travel once."""
    rows = old.withColumn("_old", F.lit(True)).unionByName(
        new.withColumn("_old", F.lit(False)), allowMissingColumns=True
    )
    rows = rows.repartitionByRange(key) if ranged else rows.repartition(key)
    is_open = F.col("_old") & F.col("dbt_valid_to").isNull()
    pairs, keys = Window.partitionBy(key, "_pair"), Window.partitionBy(key)
    rows = (
        rows.withColumn("_pair", _pair(key, check))
        .withColumns(
            {
                "_same": F.bool_or(~F.col("_old")).over(pairs),
                "_known": F.bool_or(is_open).over(pairs),
            }
        )
        .withColumn("_loaded", F.bool_or(~F.col("_old")).over(keys))
        .where(F.col("_old") | ~F.col("_known"))
    )
    replaced = is_open & F.col("_loaded") & ~F.col("_same")
    kept = {"dbt_valid_to": F.when(replaced, at).otherwise(F.col("dbt_valid_to"))}
    added = {c: F.when(F.col("_old"), F.col(c)).otherwise(v) for c, v in _version(key, at).items()}
    return rows.withColumns(added | kept).select(old.columns)


def _compared_by_pair(
    history: DataFrame, current: DataFrame, key: str, check: Sequence[str], at: Column, hot: Hot
) -> DataFrame:
    """The rows of a key spread over tasks by their content."""
    old, new = (rows.withColumn("_pair", _pair(key, check)) for rows in (history, current))
    is_open = F.col("dbt_valid_to").isNull()
    known = old.where(is_open).select("_pair").distinct()
    added = new.join(known, "_pair", "left_anti").select(*current.columns)

    keys = new.select(key).distinct().withColumn("_loaded", F.lit(True))
    pairs = new.select("_pair").distinct()
    compared = salted_join(old, keys, key, "left", hot).join(
        pairs.withColumn("_same", F.lit(True)), "_pair", "left"
    )
    replaced = is_open & F.col("_loaded") & F.col("_same").isNull()
    kept = compared.withColumn(
        "dbt_valid_to", F.when(replaced, at).otherwise(F.col("dbt_valid_to"))
    ).select(*history.columns)
    return kept.unionByName(_versions(added, key, at))


def _range_of(key: str, bounds: Sequence) -> Column:
    """The number of the range of a key: how many bounds are not above it, found by halving."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        above = F.col(key) >= F.lit(bounds[middle])
        return F.when(above, search(middle + 1, high)).otherwise(search(low, middle))

    return F.when(F.col(key).isNull(), F.lit(-1)).otherwise(search(0, len(bounds)))


def _bounds(current: DataFrame, key: str, ranges: int) -> list:
    """Keys that cut a table into ranges of about the same number of rows; at most `ranges`."""
    keys = current.where(F.col(key).isNotNull()).select(key).repartitionByRange(ranges, key)
    least = keys.groupBy(F.spark_partition_id()).agg(F.min(key).alias("least"))
    return sorted(r["least"] for r in least.collect())[1:]


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    return None


def merge_snapshot(
    path: str,
    current: DataFrame,
    key: str,
    check: Sequence[str],
    at: datetime,
    hot: Hot | None = None,
    ranges: int = RANGES,
) -> None:
    """`apply_snapshot` on a history that is stored below `path`, rewriting what the load touches.

    Open versions are kept by range of keys, closed ones by the load that closed them. A load reads
    and rewrites the ranges it has keys in and adds the versions it closes; nothing else is read.
    The ranges are cut at the first load. A load that was broken off can be run again: what it
    closes is written, under its time, before the open versions change, and is not written again
    once it is complete. Loads run one after the other, in order of `at`.
    """
    spark = current.sparkSession
    old = _read(spark, f"{path}/open")
    if old is None:
        cuts = _bounds(current, key, ranges)
        schema = f"place int, least {current.schema[key].dataType.simpleString()}"
        spark.createDataFrame(list(enumerate(cuts)), schema).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/bounds"
        )
    known = spark.read.parquet(f"{path}/bounds").orderBy("place").collect()
    place = _range_of(key, [r["least"] for r in known])
    if old is None:
        merged = apply_snapshot(None, current.repartitionByRange(key), key, check, at)
    else:
        touched = current.select(place.alias("r")).distinct().collect()
        old = old.where(F.col(_RANGE).isin(*[r["r"] for r in touched])).drop(_RANGE)
        merged = _compared(old, current, key, check, F.lit(at).cast("timestamp"), hot, ranged=True)
    merged = stored(merged, "merged")
    closed = f"{path}/closed/load={at:%Y%m%d%H%M%S%f}"
    if _read(spark, closed) is None:
        merged.where("dbt_valid_to IS NOT NULL").write.mode("overwrite").parquet(closed)
    # the stored rows lie in ranges of the key, so a task writes to few folders
    (
        merged.where("dbt_valid_to IS NULL")
        .withColumn(_RANGE, place)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(_RANGE)
        .parquet(f"{path}/open")
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a history stored by `merge_snapshot`."""
    opened = spark.read.parquet(f"{path}/open").drop(_RANGE)
    closed = spark.read.parquet(f"{path}/closed")
    return opened.unionByName(closed.select(opened.columns))
