"""Cutting lineage with tables in the folder all executors share."""

import tempfile
import uuid
from collections.abc import Mapping

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# Keys are hexadecimal digits, which this codec halves and the usual one leaves as they are.
CODEC = "zstd"
# Bytes of a row group, before compression, of tables whose rows are much work: no split cuts one.
ROW_GROUP_BYTES = 32_000_000
_SPLITS = "spark.sql.files.minPartitionNum"
SPLITS_PER_CORE = 4


def shared_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder in local mode only."""
    folder = spark.conf.get(_SETTING, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ratebook-")
        spark.conf.set(_SETTING, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str, row_group_bytes: int | None = None) -> DataFrame:
    """Write once as Parquet, read back.

    Unlike a cache it survives executor loss, and unlike a checkpoint the
    readers keep column pruning, filter pushdown and known sizes.
    """
    path = new_folder(df.sparkSession, name)
    writer = df.write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_all(
    tables: Mapping[str, DataFrame], row_group_bytes: int | None = None
) -> dict[str, DataFrame]:
    """Store several tables at the same time, so small jobs do not wait for one another."""
    done: dict[str, DataFrame] = {}
    failed: list[Exception] = []

    def store(name: str, df: DataFrame) -> None:
        try:
            done[name] = stored(df, name, row_group_bytes)
        except Exception as error:
            failed.append(error)

    for df in list(tables.values())[:1]:
        shared_folder(df.sparkSession)
    threads = [InheritableThread(target=store, args=item) for item in tables.items()]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if failed:
        raise failed[0]
    return {name: done[name] for name in tables}


def read_in_small_splits(spark: SparkSession) -> None:
    """Let the session read tables in several splits for each core.

    By default Spark asks for one, and files of uneven size make a few more of them than there are
    cores: then most cores wait while the last splits are read. A setting of the user's stays.
    """
    if spark.conf.get(_SPLITS, None) is None:
        spark.conf.set(_SPLITS, str(SPLITS_PER_CORE * spark.sparkContext.defaultParallelism))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a table that is read in fewer splits than there are cores.

    A table of many splits, the usual case, is returned as it is. For plain
    scans: counting the partitions of anything else could run a job.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
