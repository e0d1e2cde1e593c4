"""Surrogate keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def md5_key(column: Column) -> Column:
    """md5 hex of a text; NULL stays NULL."""
    return F.md5(column)


def packed_key(key: Column) -> Column:
    """The 16 bytes of an md5 key, for a shuffle, which cannot compress its digits."""
    return F.unhex(key)


def unpacked_key(packed: Column) -> Column:
    return F.lower(F.hex(packed))


def surrogate_key(*columns: Column) -> Column:
    """md5 over all columns joined by '-'; never NULL, NULL parts get a marker."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY_TEXT)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))
