"""Joins and repetition that do not depend on evenly spread keys."""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import stored

# Rows of one key that a single task handles without trouble.
HOT_ROWS = 1_000_000
# Estimated bytes of a table that fit every executor.
BROADCAST_BYTES = 32_000_000
_STEP = 65_536
_REPEATABLE = (
    T.StringType,
    T.IntegralType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.BooleanType,
)


@dataclass(frozen=True)
class HotKeys:
    """Keys with very many rows: a stored table (key, n), its rows, and the rows they have in all."""

    table: DataFrame
    keys: int
    rows: int

    def __bool__(self) -> bool:
        return self.keys > 0


# Hot keys and their number of rows; few of them may be given as they are.
Hot = HotKeys | Mapping


def hot_keys(
    df: DataFrame, key: str, weight: Column | None = None, min_rows: int = HOT_ROWS
) -> HotKeys:
    """All keys with more than `min_rows` rows, and their row counts.

    Reads the key column only and combines before the shuffle. The keys are stored and joined like
    any other table, so there is no bound on how many there may be.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
    heavy = counts.agg(rows.cast("bigint").alias("n")).where(F.col("n") > min_rows)
    table = stored(heavy, "hot_keys")
    keys, total = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return HotKeys(table, keys, total)


def hot_rows(hot: Hot) -> int:
    """Rows of all hot keys."""
    return hot.rows if isinstance(hot, HotKeys) else sum(hot.values())


def slices_for(rows: int, per_slice: int = HOT_ROWS) -> int:
    """Tasks to spread that many rows over, two at least."""
    return max(2, -(-rows // per_slice))


def hot_table(df: DataFrame, key: str, hot: Hot, per_slice: int = HOT_ROWS) -> DataFrame:
    """The hot keys and their number of salts; of a stored table Spark broadcasts them if they are few."""
    kind = df.schema[key].dataType
    if isinstance(hot, HotKeys):
        table = hot.table
    else:
        schema = T.StructType([T.StructField("key", kind), T.StructField("n", T.LongType())])
        table = F.broadcast(df.sparkSession.createDataFrame(list(hot.items()), schema))
    salts = F.greatest(F.lit(2), F.ceil(F.col("n") / per_slice)).cast("int")
    return table.select(F.col("key").cast(kind).alias(key), salts.alias("_salts"))


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table surely has at most so many bytes, by the sizes of the files it comes from.

    Runs no job. What Spark cannot tell the size of is not small.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= max_bytes


def _salt_of(left: DataFrame, key: str, salts: Column) -> Column:
    """A salt that differs between the rows of a key, and that a re-run task reproduces.

    It comes from the row's other columns, so it holds where `left` is shuffled on the key
    already, and from the partition id, which spreads exact copies. Floating-point columns, whose
    sums may differ in a re-run, are left out.
    """
    parts = [
        f.name for f in left.schema.fields if f.name != key and isinstance(f.dataType, _REPEATABLE)
    ]
    salt = F.pmod(F.spark_partition_id(), salts)
    if parts:
        salt = F.pmod(salt + F.pmod(F.xxhash64(*parts), salts), salts)
    return salt.cast("int")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    hot: Hot | None = None,
    per_slice: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join (inner or left) that spreads the hot keys of `left` over many tasks.

    A hot key gets a salt per `per_slice` rows; only right rows of hot keys are
    repeated, once per salt.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join does not support {how!r}")
    if not hot:
        return left.join(right, key, how)
    marks = hot_table(left, key, hot, per_slice)
    spread = left.join(marks, key, "left").withColumn(
        "_salt",
        F.when(
            F.col("_salts").isNotNull(), _salt_of(left, key, F.col("_salts"))
        ).otherwise(0),
    )
    last = F.coalesce(F.col("_salts") - 1, F.lit(0))
    repeated = right.join(marks, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), last))
    )
    columns = left.columns + [c for c in right.columns if c != key]
    joined = spread.drop("_salts").join(repeated.drop("_salts"), [key, "_salt"], how)
    return joined.select(columns)


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    key: str,
    how: str,
    max_bytes: int = BROADCAST_BYTES,
    min_hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join a dimension: broadcast when it has at most `max_bytes`, else salted.

    `table` should be a stored table, whose size is known. In the second case rows
    without a key skip the shuffle: a left join only adds NULL columns to them.
    Hot keys are looked for in `counted`, a table `left` comes from, so that the
    joins before this one do not run for it.
    """
    if is_small(table, max_bytes):
        return left.join(F.broadcast(table), key, how)
    hot = hot_keys(left if counted is None else counted, key, min_rows=min_hot_rows)
    if how == "inner":
        return salted_join(left, table, key, how, hot, min_hot_rows)
    joined = salted_join(
        left.where(F.col(key).isNotNull()), table, key, how, hot, min_hot_rows
    )
    absent = [
        F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields if f.name != key
    ]
    return joined.unionByName(left.where(F.col(key).isNull()).select("*", *absent))


def repeat_rows(df: DataFrame, times: str, index: str, slices: int | None = None) -> DataFrame:
    """Emit each row `times` times, numbered 1.. in `index`.

    Large counts are cut into steps first; with `slices` the steps are spread
    over that many tasks before they are expanded, so no task emits a whole
    group of copies.
    """
    last_step = F.expr(f"(`{times}` - 1) DIV {_STEP}")
    steps = df.where(F.col(times) > 0).withColumn(
        "_step", F.explode(F.sequence(F.lit(0).cast("bigint"), last_step))
    )
    if slices:
        steps = steps.repartition(slices, *[c for c in steps.columns])
    low = F.col("_step") * _STEP + 1
    high = F.least(F.col(times), (F.col("_step") + 1) * _STEP)
    return steps.withColumn(index, F.explode(F.sequence(low, high))).drop("_step")
