"""SQL surface: the month function as a SQL function, inlined by Catalyst (no Python)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_sql_functions(spark: SparkSession) -> None:
    """``changeDate(epoch_seconds INT) -> yyyyMM INT`` for ad-hoc SQL."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION changeDate(x INT) RETURNS INT "
              "RETURN CAST(date_format(timestamp_seconds(x), 'yyyyMM') AS INT)")
