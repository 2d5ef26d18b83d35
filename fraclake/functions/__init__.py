"""Column helpers: unsigned 64-bit handling, mixing, hashing, file naming."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_sql(spark: SparkSession) -> None:
    """Make splitmix64(x), hash_bucket(x, bits) and murmur64(text) available to SQL."""
    from fraclake.functions import hashing, mixing

    mixing.register_sql(spark)
    hashing.register_sql(spark)
