"""Helpers of the operators: row keys, jobs over Arrow batches, sizes."""

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


# Bytes of a group after which freed memory is returned to the system.
_LARGE = 4_000_000


def partitions(spark: SparkSession) -> int:
    """Tasks after a shuffle, as the session has it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to Python workers that do not have it installed, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def row_key(id_column: str, text_column: str) -> Column:
    """64 bits that stand for a row's id and text; equal rows share it, and every result."""
    return F.xxhash64(
        F.coalesce(F.col(id_column).cast("string"), F.lit("\0null")),
        F.coalesce(F.col(text_column), F.lit("")),
    )


def keyed(
    docs: DataFrame, id_column: str, text_column: str, carried: tuple[str, ...] = ()
) -> DataFrame:
    """key, doc_id, text and carried columns of all rows; a null text is empty."""
    return docs.select(
        row_key(id_column, text_column).alias("key"),
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        *carried,
    )


def map_batches(
    df: DataFrame, job: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """mapInArrow for a job that yields columns as a dict of lists or arrays."""
    fields = arrow_schema(schema)
    ship_package(df.sparkSession)

    def run(batches):
        for columns in job(batches):
            yield record_batch(columns, fields)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on, and its arrays of one task are large."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def record_batch(columns: dict, fields: pa.Schema) -> pa.RecordBatch:
    def made(column, kind: pa.DataType) -> pa.Array:
        if not isinstance(column, pa.Array):
            return pa.array(column, kind)
        return column if column.type == kind else column.cast(kind)

    return pa.RecordBatch.from_arrays(
        [made(columns[field.name], field.type) for field in fields], schema=fields
    )


_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
}


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a list of "name type"; types that are not plain are left to Spark."""
    parts = [part.split() for part in schema.split(",")]
    if any(len(part) != 2 or part[1] not in _TYPES for part in parts):
        return to_arrow_schema(StructType.fromDDL(schema))
    return pa.schema([pa.field(name, _TYPES[kind]) for name, kind in parts])


def id_type(df: DataFrame, column: str) -> str:
    """The name of a column's type in schemas of this module."""
    return {"bigint": "long"}.get(name := df.schema[column].dataType.simpleString(), name)


def group_batches(
    df: DataFrame, key: str, job: Callable[[pa.Table], Iterator[dict]], schema: str
) -> DataFrame:
    """applyInArrow for a job that yields columns as a dict of lists or arrays."""
    fields = arrow_schema(schema)
    ship_package(df.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        made = [record_batch(columns, fields) for columns in job(table)]
        if table.nbytes > _LARGE:
            give_back()
        return pa.Table.from_batches(made, schema=fields)

    return df.groupBy(key).applyInArrow(run, schema)


def cogroup_batches(
    left: DataFrame,
    right: DataFrame,
    key: str,
    job: Callable[[pa.Table, pa.Table], Iterator[dict]],
    schema: str,
) -> DataFrame:
    """applyInArrow on both sides' rows of a key, for a job that yields columns as a dict."""
    fields = arrow_schema(schema)
    ship_package(left.sparkSession)

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        made = [record_batch(columns, fields) for columns in job(one, two)]
        return pa.Table.from_batches(made, schema=fields)

    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(run, schema)
