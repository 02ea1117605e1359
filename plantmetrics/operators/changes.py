"""Keyed snapshots and their change log: upsert, change feed, state at a version, restore, incremental load.

A change log holds key and data columns plus `_change_type` (insert, delete, update_preimage, update_postimage),
`_commit_version` and `_commit_timestamp`.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.functions.expressions import moment
from plantmetrics.operators.quality import incremental_bounds
from plantmetrics.sources.tables import append_evolve, union_by_name

LOG_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")
FILTER_BITS = 1 << 23


def _stamp(version: int | Column, timestamp: str) -> list[Column]:
    number = version if isinstance(version, Column) else F.lit(version)
    return [number.cast("long").alias("_commit_version"), F.lit(timestamp).cast("timestamp_ntz").alias("_commit_timestamp")]


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, failing the job when a key repeats. Copies are counted before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in rest])
    names = ", ".join(keys)
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"source key ({names}) repeats"))).otherwise(F.col("_n"))
    # The check sits in the filter so that it cannot be pruned with an unused column.
    return one.filter(checked.cast("long") == 1).select(*df.columns)


def _slot(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1


def flag_possible(target: DataFrame, source: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS, out: str = "_possible") -> DataFrame:
    """Target rows with whether their key can be one of the source's; never false for one that is, nor true for a NULL in a key.

    The source's key hashes are a bitmap of `bits` bits in pieces of 4 KB, whatever its size, so the broadcast is bounded (1 MB)
    and the target stays where it is.
    """
    slots = source.select(_slot(keys, bits).alias("_slot"))
    pieces = slots.groupBy(F.bitmap_bucket_number("_slot").alias("_piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    placed = target.withColumn("_at", _slot(keys, bits)).withColumn("_piece", F.bitmap_bucket_number("_at"))
    bit = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.expr("substring(_bits, CAST(bitmap_bit_position(_at) DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    held = F.coalesce(F.bit_get(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return placed.join(F.broadcast(pieces), "_piece", "left").withColumn(out, held & known).drop("_at", "_piece", "_bits")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str],
    update: Sequence[str] | None = None, insert: Sequence[str] | None = None, bits: int = FILTER_BITS,
) -> DataFrame:
    """Matched rows take the `update` columns of the source, other source rows come in with the `insert` columns.

    Both default to all source columns. Columns not listed stay as they are on update and are NULL on insert. Target rows whose
    key the source cannot hold pass as they are, without a shuffle; only the others meet the source in a join.
    """
    listed = [c for c in source.columns if c not in keys]
    updated = listed if update is None else [c for c in update if c not in keys]
    inserted = listed if insert is None else [c for c in insert if c not in keys]
    flagged = flag_possible(target, source, keys, bits)
    left = flagged.filter("_possible").select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_t"))
    right = unique_rows(source, keys).select(*keys, F.struct(*listed).alias("_s"))
    both = left.join(right, list(keys), "full_outer")
    columns = []
    for field in target.schema.fields:
        name = field.name
        if name in keys:
            columns.append(F.col(name))
            continue
        absent = F.lit(None).cast(field.dataType)
        fresh = F.col(f"_s.{name}").cast(field.dataType) if name in listed else absent
        on_match = fresh if name in updated else F.col(f"_t.{name}")
        on_insert = fresh if name in inserted else absent
        columns.append(
            F.when(F.col("_s").isNull(), F.col(f"_t.{name}")).when(F.col("_t").isNull(), on_insert).otherwise(on_match)
            .alias(name)
        )
    return flagged.filter("NOT _possible").select(*target.columns).unionByName(both.select(*columns))


def new_rows(source: DataFrame, target: DataFrame, ts: str, default: str = "2000-01-01 00:00:00") -> DataFrame:
    """Source rows newer than the newest target row (or `default` for an empty target)."""
    kind = source.schema[ts].dataType
    mark = target.agg(F.coalesce(F.max(ts).cast(kind), F.lit(default).cast(kind)).alias("mark")).scalar()
    return source.filter(F.col(ts) > mark)


def advance_checkpoint(checkpoints: DataFrame, name: str, version: int | Column, updated_at: str) -> DataFrame:
    """Upsert of one name's last processed version into the checkpoint table."""
    number = version if isinstance(version, Column) else F.lit(version)
    row = checkpoints.sparkSession.range(1).select(
        F.lit(name).alias("pipeline_name"), number.cast("long").alias("last_processed_version"),
        F.lit(updated_at).cast(checkpoints.schema["updated_at"].dataType).alias("updated_at"),
    )
    return merge_upsert(checkpoints, row, ["pipeline_name"])


def initial_load(df: DataFrame, version: int, timestamp: str) -> DataFrame:
    """Log of a first version: every row an insert."""
    return df.select("*", F.lit("insert").alias("_change_type"), *_stamp(version, timestamp))


def change_feed(
    before: DataFrame, after: DataFrame, keys: Sequence[str], version: int | Column, timestamp: str,
    check_keys: bool = True,
) -> DataFrame:
    """Log rows that lead from one snapshot to the next; an update gives its row before and after.

    The job fails when a key repeats in a snapshot; `check_keys=False` leaves the check out where keys are known unique.
    """
    values = [c for c in before.columns if c not in keys]
    if check_keys:
        before, after = unique_rows(before, keys), unique_rows(after, keys)
    left = before.select(*keys, F.struct(*values).alias("_b"))
    right = after.select(*keys, F.struct(*values).alias("_a"))
    return _images(left.join(right, list(keys), "full_outer"), keys, before.columns, version, timestamp)


def _images(pairs: DataFrame, keys: Sequence[str], columns: Sequence[str], version: int | Column, timestamp: str) -> DataFrame:
    """Log rows of (keys, _b, _a): a row's other columns before and after, NULL where there is none."""
    b, a = F.col("_b"), F.col("_a")

    def image(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), row.alias("_row"))

    images = (
        F.when(b.isNull() & a.isNotNull(), F.array(image("insert", a)))
        .when(b.isNotNull() & a.isNull(), F.array(image("delete", b)))
        .when(~b.eqNullSafe(a), F.array(image("update_preimage", b), image("update_postimage", a)))
    )
    changed = pairs.select(*keys, F.explode(images).alias("_c"))
    return changed.select(
        *keys, *[F.col(f"_c._row.{c}").alias(c) for c in columns if c not in keys], F.col("_c._change_type").alias("_change_type"),
        *_stamp(version, timestamp),
    ).select(*columns, *LOG_COLUMNS)


def changes_between(log: DataFrame, first: int, last: int | None = None, kinds: Sequence[str] = ()) -> DataFrame:
    """Log rows from version `first` to `last` (open when None), optionally of some kinds."""
    found = log.filter(F.col("_commit_version") >= first)
    if last is not None:
        found = found.filter(F.col("_commit_version") <= last)
    return found.filter(F.col("_change_type").isin(*kinds)) if kinds else found


def change_summary(log: DataFrame) -> DataFrame:
    """Rows per change type and version."""
    return log.groupBy("_change_type", "_commit_version").agg(F.count("*").alias("row_count"))


def delete_where(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows that stay after a conditional delete; a NULL condition keeps the row."""
    test = F.expr(condition) if isinstance(condition, str) else condition
    return df.filter(~F.coalesce(test, F.lit(False)))


def _last_change(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest row per key, preimages aside. The rank limit runs before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.desc("_commit_version"))
    live = log.filter("_change_type <> 'update_preimage'")
    return live.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def state_as_of(log: DataFrame, keys: Sequence[str], version: int | None = None, timestamp: str | None = None) -> DataFrame:
    """The snapshot as of a version or a moment (newest when neither is given)."""
    if version is not None:
        log = log.filter(F.col("_commit_version") <= version)
    if timestamp is not None:
        log = log.filter(F.col("_commit_timestamp") <= moment(log, "_commit_timestamp", timestamp))
    return _last_change(log, keys).filter("_change_type <> 'delete'").drop(*LOG_COLUMNS)


def restore(log: DataFrame, keys: Sequence[str], version: int, new_version: int, timestamp: str) -> DataFrame:
    """The log with a new version appended that leads back to the state of an old one.

    Only the log behind that version is read: per key its first change there tells what the row was, its last one what it is, and
    the inverse of both together is one change. Keys that were not touched since are never looked at. The new version has to be the
    greatest; where the log has one as great, the job fails. So whoever reads the new version alone need not read the log for it.
    """
    values = [c for c in log.columns if c not in keys and c not in LOG_COLUMNS]
    kind, row = F.col("_change_type"), F.struct(*values)
    was = F.struct(F.when(kind != "insert", row).alias("row"))
    now = F.struct(F.when(kind != "delete", row).alias("row"))
    number = F.col("_commit_version")
    late = F.raise_error(F.concat(F.lit("the log has version "), number.cast("string"), F.lit(f", not before {new_version}")))
    tail = log.filter(number > version).filter(F.when(number >= new_version, late.cast("boolean")).otherwise(True))
    turned = tail.groupBy(*keys).agg(
        F.min_by(was, F.when(kind != "update_postimage", F.col("_commit_version")))["row"].alias("_a"),
        F.max_by(now, F.when(kind != "update_preimage", F.col("_commit_version")))["row"].alias("_b"),
    )
    columns = [c for c in log.columns if c not in LOG_COLUMNS]
    # The condition holds for every row, or the tail fails; by it a filter on the new version leaves the log out.
    old = log.filter(F.coalesce(number < new_version, F.lit(True)))
    return old.unionByName(_images(turned, keys, columns, new_version, timestamp))


def version_counts(versions: dict[str, DataFrame]) -> DataFrame:
    """Rows (version, cnt), one per named snapshot."""
    return union_by_name(
        [df.agg(F.count("*").alias("cnt")).select(F.lit(name).alias("version"), "cnt") for name, df in versions.items()]
    )


def history_summary(log: DataFrame) -> DataFrame:
    """Per change type its first version, next to the newest version of the log."""
    per_type = log.groupBy("_change_type").agg(
        F.min("_commit_version").alias("first_version"), F.max("_commit_version").alias("_last")
    )
    # At most four rows by now.
    return per_type.withColumn("latest_version", F.max("_last").over(Window.partitionBy())).drop("_last")


def expire_changes(log: DataFrame, keys: Sequence[str], as_of: str, hours: int = 168) -> DataFrame:
    """Log without rows older than the retention, except those that any kept state still needs.

    Needed is each key's newest row at the cut-off, unless it is a delete.
    """
    cut = moment(log, "_commit_timestamp", as_of, hours=hours)
    recent = log.filter(F.col("_commit_timestamp") >= cut)
    base = _last_change(log.filter(F.col("_commit_timestamp") < cut), keys).filter("_change_type <> 'delete'")
    return recent.unionByName(base)


class IncrementalLoad(NamedTuple):
    target: DataFrame
    checkpoints: DataFrame
    status: DataFrame


def incremental_clean(
    log: DataFrame, target: DataFrame, checkpoints: DataFrame, name: str, updated_at: str,
    min_version: int = 0, dedup_keys: Sequence[str] = (),
) -> IncrementalLoad:
    """Append inserts since the checkpoint, cleaned, and advance the checkpoint.

    Nothing to do shows as an unchanged target and checkpoint and as status `up_to_date` or `no_inserts`. A restored
    row is an insert in the log: with `dedup_keys` only rows whose key the target lacks are appended.
    """
    saved = checkpoints.filter(F.col("pipeline_name") == name).agg(F.max("last_processed_version").alias("v")).scalar()
    last = F.greatest(F.coalesce(saved, F.lit(0)), F.lit(min_version))
    inserts = log.filter((F.col("_change_type") == "insert") & (F.col("_commit_version") > last))
    cleaned = incremental_bounds(inserts)
    if dedup_keys:
        w = Window.partitionBy(*dedup_keys).orderBy("_commit_version")
        first = cleaned.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
        cleaned = first.join(target.select(*dedup_keys), list(dedup_keys), "left_anti")
    loaded = append_evolve(target, cleaned.drop(*LOG_COLUMNS))

    facts = log.agg(
        F.max("_commit_version").alias("latest"),
        F.max(F.when((F.col("_change_type") == "insert") & (F.col("_commit_version") > last), F.col("_commit_version"))).alias("done"),
    )
    kind = checkpoints.schema["updated_at"].dataType
    mark = facts.filter("done IS NOT NULL").select(
        F.lit(name).alias("pipeline_name"), F.col("done").alias("last_processed_version"),
        F.lit(updated_at).cast(kind).alias("updated_at"),
    )
    state = (
        F.when(F.coalesce(F.col("latest"), F.lit(0)) <= last, "up_to_date").when(F.col("done").isNull(), "no_inserts")
        .otherwise("processed")
    )
    status = facts.select(state.alias("status"), last.alias("from_version"), F.col("latest").alias("latest_version"))
    return IncrementalLoad(loaded, merge_upsert(checkpoints, mark, ["pipeline_name"]), status)
