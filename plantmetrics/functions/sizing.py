"""Stored per-key sides that Spark broadcasts by size, and null-safe joins on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.session import scratch_path


def stored(df: DataFrame, label: str = "side") -> DataFrame:
    """`df` written once below the shared folder and read back.

    The rows are computed one time however often the result is used, survive lost executors, and have a size that
    Spark knows from the files when it plans.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame) -> DataFrame:
    """A per-key side for a join with the full table.

    Without this, a side that comes out of an aggregate has no known size, so the plan shuffles the full table before
    adaptive execution can learn that the side was small. Stored, it is broadcast when its files are below
    spark.sql.autoBroadcastJoinThreshold; a larger one stays an ordinary join input with adaptive skew handling.
    """
    return stored(df)


def join_back(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join unique per-key columns back to the rows; NULL keys match each other as in a window partition."""
    renamed = side.select(
        *[F.col(k).alias(f"__{k}") for k in keys], *[c for c in side.columns if c not in keys]
    )
    condition = None
    for k in keys:
        same = rows[k].eqNullSafe(renamed[f"__{k}"])
        condition = same if condition is None else condition & same
    return rows.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])
