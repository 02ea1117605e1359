"""Conversation threads and run or error logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.operators.ordered import top_n_per_key


def assemble_threads(messages: DataFrame) -> DataFrame:
    """Ordered messages per thread, one row each; a thread has to fit a row, as its reader takes it whole."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return (
        messages.groupBy("conv_id").agg(ordered.alias("m"))
        .select("conv_id", F.transform("m", lambda x: F.struct(x["role"], x["content"])).alias("messages"))
    )


def session_keys(messages: DataFrame) -> DataFrame:
    """First user message of each thread."""
    return messages.filter("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("session_key"))


def last_answer(messages: DataFrame, role: str = "assistant") -> DataFrame:
    """Last non-empty message of a role per thread."""
    said = messages.filter((F.col("role") == role) & (F.length("text") > 0))
    return said.groupBy("conv_id").agg(F.max_by("text", "turn").alias("answer"))


def speakers(messages: DataFrame, excluded: str) -> DataFrame:
    """Distinct speakers per thread in the order they first spoke, one excluded. Reduced to roles before collecting."""
    first = messages.filter(F.col("role") != excluded).groupBy("conv_id", "role").agg(F.min("turn").alias("turn"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return first.groupBy("conv_id").agg(F.transform(ordered, lambda x: x["role"]).alias("speakers"))


def latest_errors(log: DataFrame, source: str, is_error: Column, ts: str, n: int = 5, tie: Sequence[str] = ()) -> DataFrame:
    """Newest n error events per source."""
    return top_n_per_key(log.filter(is_error), [source], [F.desc(ts), *[F.desc(c) for c in tie]], n)


def latest_runs(
    runs: DataFrame, source: str, ts: str, state: str, n: int = 5, default: str = "RUNNING", tie: Sequence[str] = ()
) -> DataFrame:
    """Newest n runs per source; a run without an end state counts as running."""
    newest = top_n_per_key(runs, [source], [F.desc(ts), *[F.desc(c) for c in tie]], n)
    return newest.withColumn(state, F.coalesce(F.col(state), F.lit(default)))
