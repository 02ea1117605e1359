"""Column masking and audit-log reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.functions.expressions import masked, night, since

READ_ACTIONS = ("getTable", "executeQuery", "updateTable", "deleteTable")


def mask(df: DataFrame, column: str, roles: Sequence[str], allowed: Sequence[str] = ("de-team", "admin")) -> DataFrame:
    """Show the column to allowed roles; others see its first two characters and ***."""
    visible = bool(set(roles) & set(allowed))
    return df if visible else df.withColumn(column, masked(F.col(column)))


def mask_by_row(df: DataFrame, column: str, roles: str, allowed: Sequence[str] = ("de-team", "admin")) -> DataFrame:
    """As `mask`, with the roles of the reader in an array column."""
    visible = F.arrays_overlap(F.col(roles), F.array(*[F.lit(a) for a in allowed]))
    return df.withColumn(column, F.when(visible, F.col(column)).otherwise(masked(F.col(column))))


def recent_access(log: DataFrame, as_of: str, days: int = 1, actions: Sequence[str] = READ_ACTIONS, n: int = 100) -> DataFrame:
    """Newest n accesses of the last days."""
    found = log.filter(since(log, "event_date", as_of, days) & F.col("action_name").isin(*actions))
    return found.select("event_time", "user_email", "action_name", "table_name", "status").orderBy(
        F.desc("event_time"), "user_email"
    ).limit(n)


def night_access(log: DataFrame, as_of: str, days: int = 7, action: str = "executeQuery", more_than: int = 10) -> DataFrame:
    """Users with more than `more_than` queries between 22:00 and 06:59."""
    found = log.filter(
        night(F.col("event_time")) & since(log, "event_date", as_of, days) & (F.col("action_name") == action)
    )
    return (
        found.groupBy("user_email")
        .agg(F.count("*").alias("access_count"), F.min("event_time").alias("first_access"), F.max("event_time").alias("last_access"))
        .filter(F.col("access_count") > more_than)
        .orderBy(F.desc("access_count"), "user_email")
    )


def table_access(log: DataFrame, table: str, as_of: str, days: int = 30) -> DataFrame:
    """Accesses to one table per day and user."""
    found = log.filter((F.col("table_name") == table) & since(log, "event_date", as_of, days))
    return (
        found.groupBy(F.to_date("event_time").alias("access_date"), "user_email").agg(F.count("*").alias("query_count"))
        .orderBy(F.desc("access_date"), F.desc("query_count"), "user_email")
    )


def register_mask(spark: SparkSession, name: str, roles: Sequence[str], allowed: Sequence[str] = ("de-team", "admin")) -> None:
    """SQL form of `mask` for the given reader: a temporary function name(value)."""
    body = "value" if set(roles) & set(allowed) else "concat(left(value, 2), '***')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN {body}")
