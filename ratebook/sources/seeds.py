"""Seed CSV files with fixed column types."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import varchar

# Declared widths of reference columns.
WIDTHS = {
    "ref_payers": {"payer_id": 50, "payer_name": 200, "payer_type": 50},
    "ref_service_categories": {"category_code": 20, "category_name": 100, "description": 500},
}


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One seed table; `path` is the folder or the file."""
    file = path if path.endswith(".csv") else f"{path}/{name}.csv"
    seed = spark.read.schema(schemas.SEEDS[name]).option("header", True).csv(file)
    return seed.withColumns(
        {c: varchar(F.col(c), width) for c, width in WIDTHS.get(name, {}).items()}
    )
