"""File ingest with a schema log, and a daily view that follows its stream batch by batch."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructField, StructType

from plantmetrics.streaming.ingest import ingest_files


def widened(known: StructType, seen: StructType) -> StructType:
    """Known columns in their order, then new ones; a column that comes back with another type is an error."""
    types: dict[str, DataType] = {f.name: f.dataType for f in known}
    fields = list(known.fields)
    for field in seen:
        if field.name not in types:
            fields.append(StructField(field.name, field.dataType, True))
        elif types[field.name] != field.dataType:
            raise ValueError(f"column {field.name} was {types[field.name].simpleString()} and comes as {field.dataType.simpleString()}")
    return StructType(fields)


def schema_versions(spark: SparkSession, log: str) -> list[StructType]:
    """Stored versions, oldest first; none for a log that does not exist yet."""
    try:
        rows = spark.read.schema("version int, schema string").json(log).orderBy("version").collect()
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = []
    return [StructType.fromJson(json.loads(r.schema)) for r in rows]


def evolve(spark: SparkSession, source: str, log: str) -> StructType:
    """The newest schema after a look at the files present; a wider one is appended to the log as a new version."""
    seen = spark.read.option("mergeSchema", "true").parquet(source).schema
    versions = schema_versions(spark, log)
    newest = versions[-1] if versions else StructType([])
    wider = widened(newest, seen)
    if len(wider) > len(newest):
        row = spark.range(1).select(F.lit(len(versions)).alias("version"), F.lit(wider.json()).alias("schema"))
        row.coalesce(1).write.mode("append").json(log)
    return wider


def ingest_evolving(
    spark: SparkSession, source: str, out: str, checkpoint: str, log: str, max_files: int = 1000
) -> StreamingQuery:
    """Append new files to `out` under the newest schema of the log. A later run with the same checkpoint goes on where this one
    ended, also when files have brought new columns in between."""
    return ingest_files(spark, source, out, checkpoint, evolve(spark, source, log), max_files)


def read_evolved(spark: SparkSession, out: str, log: str) -> DataFrame:
    """All rows ingested so far with every column of the newest version; rows older than a column have NULL there."""
    lineage = [f for f in spark.read.option("mergeSchema", "true").parquet(out).schema if f.name.startswith("_")]
    return spark.read.schema(StructType([*schema_versions(spark, log)[-1].fields, *lineage])).parquet(out)


def merge_batch(
    batch: DataFrame, batch_id: int, state: str, view: str, day: str, partials: Callable[[DataFrame], DataFrame],
    finish: Callable[[DataFrame], DataFrame],
) -> None:
    """Bring a view, stored by day, up to date with one batch.

    The batch's partials are stored under their day and the batch's number, so a repeated batch replaces its own; then the days it
    touches, and no others, are made anew from their partials. A batch that failed half way is repeated whole, with the same result.
    """
    spark = batch.sparkSession
    made = partials(batch).withColumn("batch_id", F.lit(batch_id))
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day, "batch_id").parquet(state)
    schema = StructType([f for f in made.schema if f.name not in (day, "batch_id")] + [made.schema[day], made.schema["batch_id"]])
    held = spark.read.schema(schema).parquet(state)
    days = [r[0] for r in held.filter(F.col("batch_id") == batch_id).select(day).distinct().collect()]  # A row per day of the batch.
    if days:
        touched = F.col(day).isin([d for d in days if d is not None])
        rows = held.filter(touched | F.col(day).isNull() if None in days else touched)
        finish(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(view)


def view_stream(
    stream: DataFrame, state: str, view: str, checkpoint: str, day: str, partials: Callable[[DataFrame], DataFrame],
    finish: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """The same for every batch of a stream; all present data, then the query ends."""
    def write(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, state, view, day, partials, finish)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def day_sketches(df: DataFrame, ts: str, value: str, by: Sequence[str] = (), lg_k: int = 12, when: Column | None = None) -> DataFrame:
    """(by, day, sketch): a mergeable sketch of the distinct values of each day, 2^lg_k registers."""
    rows = df if when is None else df.filter(when)
    return rows.groupBy(*by, F.to_date(ts).alias("day")).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def distinct_in(sketches: DataFrame, first: str, last: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, estimate) of the distinct values from day to day, from the stored sketches alone (none: 0 without `by`)."""
    days = sketches.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return days.groupBy(*by).agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("estimate"))
