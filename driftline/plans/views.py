"""Engine tables under names that SQL can use."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def named(spark: SparkSession, **tables: DataFrame):
    """The tables as temporary views while the block lasts; what a query over them returns stays usable afterwards."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        yield spark
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
