"""Reading, writing and re-laying-out tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.operators.ordered import global_prefix


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A Parquet table by name below a folder."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace data and schema of the table at `path`."""
    df.write.mode("overwrite").parquet(path)


def write_landing(df: DataFrame, path: str, files: int | None = None) -> None:
    """Landing copy; `files` fewer than the partitions merges them without a shuffle, else one file per partition."""
    (df.coalesce(files) if files else df).write.mode("overwrite").parquet(path)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add `_ingestion_time` and `_source_file` to a frame read from files."""
    return df.withColumns({"_ingestion_time": F.current_timestamp(), "_source_file": F.col("_metadata.file_path")})


def append_evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows whose columns may be missing or new; absent values are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def append_rows(old: DataFrame, rows: Sequence[tuple], schema: str, **constants: Column) -> DataFrame:
    """Append a few literal rows, with constant columns added to them."""
    return append_evolve(old, old.sparkSession.createDataFrame(list(rows), schema).withColumns(constants))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Combine frames by column name."""
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counted = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return union_by_name(counted)


def _code(column: str, bounds: Sequence) -> Column:
    """Range-bucket number of a value: how many bounds lie below it."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(column)))


def _bounds(df: DataFrame, columns: Sequence[str], width: int) -> dict[str, list]:
    """About `width` - 1 values per column that cut it into equal shares; the only numbers that reach the driver."""
    probs = [i / width for i in range(1, width)]
    texts = [c for c in columns if df.schema[c].dataType.typeName() in ("string", "boolean")]
    others = [c for c in columns if c not in texts]
    found = {}
    if others:
        found.update(df.agg(*[F.percentile_approx(c, probs, 10_000).alias(c) for c in others]).first().asDict())
    for c in texts:
        counted = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n"))
        ranked = global_prefix(counted, [c], F.col("_n"))
        picks = [
            F.max(F.when((F.col("before") <= F.col("total") * p) & (F.col("total") * p < F.col("before") + F.col("_n")), F.col(c)))
            for p in probs
        ]
        found[c] = ranked.agg(F.array(*picks).alias("b")).first()["b"]
    return {c: sorted({b for b in found[c] or [] if b is not None}) for c in columns}


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Bit-interleaved range-bucket numbers (2^bits buckets per column): near in all columns means near in value.

    Buckets are cut at quantiles, at most 2^bits numbers per column. The value is a long, so bits times columns is at most 63.
    """
    if bits * len(columns) > 63:
        raise ValueError(f"{bits} bits of {len(columns)} columns do not fit a long")
    width = 2**bits
    found = _bounds(df, columns, width)
    z = F.lit(0).cast("long")
    for place, column in enumerate(columns):
        code = _code(column, found[column])
        for bit in range(bits):
            taken = F.shiftright(code, bit).bitwiseAND(F.lit(1)).cast("long")
            z = z.bitwiseOR(F.shiftleft(taken, bit * len(columns) + place))
    return z


def cluster_rewrite(df: DataFrame, columns: Sequence[str], partitions: int, curve: str = "range") -> DataFrame:
    """Lay rows out so that files cover narrow ranges of `columns` ("range" by order, "z" by all at once).

    A row hash closes the sort key, so a value that fills much of the table still spreads over several files.
    """
    salt = F.xxhash64(*df.columns)
    if curve == "range":
        return df.repartitionByRange(partitions, *columns, salt).sortWithinPartitions(*columns)
    if curve != "z":
        raise ValueError("curve is 'range' or 'z'")
    keyed = df.withColumn("_z", z_value(df, columns))
    return keyed.repartitionByRange(partitions, "_z", *columns, salt).sortWithinPartitions("_z", *columns).drop("_z")


def compact(df: DataFrame, path: str, target_files: int) -> None:
    """Rewrite into about `target_files` files of even size."""
    df.repartition(target_files).write.mode("overwrite").parquet(path)
