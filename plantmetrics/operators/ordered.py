"""Order-dependent operators that never put a whole key, or the whole table, into one task.

A window partitioned by equipment would hold a third of the table when one equipment does. The operators here cut a
key's time line into bounded pieces first and carry the little that crosses a cut: a count, a last row, a maximum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from plantmetrics.functions.expressions import epoch_seconds
from plantmetrics.functions.sizing import join_back, small_side, stored

MAX_GROUP_ROWS = 100_000
START = Window.unboundedPreceding
END = Window.unboundedFollowing


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by `order`. The rank limit runs before the shuffle, so copies never pile up."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """Row with the greatest `ts` per key; ties go to the greatest `tie` columns.

    The rank limit runs before the shuffle, so a task hands on one row per key; no table is written and nothing is joined.
    """
    return dedup(df, keys, [F.desc_nulls_last(ts), *[F.desc(c) for c in tie]])


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows per key with their rank; partial rank limits run before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def global_prefix(
    df: DataFrame, order: Sequence[str], weight: Column | None = None, groups: Sequence[str] = (),
    out: str = "before", partitions: int | None = None,
) -> DataFrame:
    """Sum of `weight` (default 1) over all earlier rows of the group, and the group's total, without a single-task window.

    Rows are range-partitioned and stored; per-partition totals give each partition its offset. Storing is needed
    because range bounds are sampled: two evaluations of the same plan may cut at different rows. `order` has to be
    unique within a group, which also lets the range partitioner split any hot value.
    """
    one = F.lit(1).cast("long") if weight is None else weight
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [*groups, *order]
    placed = stored(
        df.withColumn("_w", one).repartitionByRange(n, *sort).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    totals = placed.groupBy(*groups, "_part").agg(F.sum("_w").alias("_sum"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(START, -1)
    # At most one row per partition and one more per group; with groups the stored size decides on the broadcast.
    offsets = totals.select(
        *groups, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(Window.partitionBy(*groups)).alias("total"),
    )
    inside = Window.partitionBy(*groups, "_part").orderBy(*order).rowsBetween(START, -1)
    return (
        join_back(placed, small_side(offsets) if groups else F.broadcast(offsets), [*groups, "_part"])
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum("_w").over(inside), F.lit(0)))
        .drop("_w", "_part", "_offset")
    )


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolation percentiles per group as an array, exact for any number of distinct values.

    Equal values are counted before the shuffle; only the values that sit at a wanted rank are kept. (The built-in
    percentile holds every distinct value of a group in one task.)
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n"))
    ranked = global_prefix(counted, [value], F.col("_n"), groups=[group])
    picks, edges = [], []
    for i, p in enumerate(probs):
        position = (F.col("total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("before") <= rank) & (rank < F.col("before") + F.col("_n"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"{side}{i}"))
        at = (F.col("n") - 1) * F.lit(float(p))
        share = at - F.floor(at)
        edges.append(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * share)
    found = ranked.groupBy(group).agg(F.max("total").alias("n"), *picks)
    return found.select(group, "n", F.array(*edges).alias("quantiles"))


def bracketed_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """The same percentiles as `exact_quantiles` for few groups, without sorting or storing the values.

    A mergeable sketch per group brackets each percentile; rows below a bracket are counted, and only values inside the brackets,
    some 8 / accuracy of the rows each, are ranked. The ranks next to a bracket are known from its neighbours. Groups are few
    enough for one row each to be broadcast. A sketch that missed its rank would fail the job, not change the result.
    The sketch is stored, as it is used twice and depends on the order in which its parts are merged: two evaluations may differ.
    """
    slack, k = 4 / accuracy, len(probs)
    rows = df.filter(F.col(value).isNotNull()).select(F.col(group).alias("_g"), F.col(value).alias("_v"))
    bounds = [F.percentile_approx("_v", F.array(*[F.lit(min(max(p + s, 0.0), 1.0)) for p in probs]), accuracy).alias(n) for s, n in ((-slack, "_lo"), (slack, "_hi"))]
    sketch = stored(rows.groupBy("_g").agg(F.count("*").alias("n"), *bounds), "sketch")
    known = rows.join(F.broadcast(sketch), rows["_g"].eqNullSafe(sketch["_g"])).drop(sketch["_g"])
    lo, hi = [F.get("_lo", F.lit(i)) for i in range(k)], [F.get("_hi", F.lit(i)) for i in range(k)]
    around = known.groupBy("_g").agg(
        F.first("n").alias("n"), F.array(*[F.count_if(F.col("_v") < b) for b in lo]).alias("_below"),
        F.array(*[F.max(F.when(F.col("_v") < b, F.col("_v"))) for b in lo]).alias("_prev"),
        F.array(*[F.min(F.when(F.col("_v") > b, F.col("_v"))) for b in hi]).alias("_next"),
    )
    inside = F.array_compact(F.array(*[F.when(F.col("_v").between(a, b), F.lit(i)) for i, (a, b) in enumerate(zip(lo, hi, strict=True))]))
    counted = known.select("_g", "_v", F.explode(inside).alias("_i")).groupBy("_g", "_i", "_v").agg(F.count("*").alias("_c"))
    before = Window.partitionBy("_g", "_i").orderBy("_v").rowsBetween(START, -1)
    ranked = counted.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    placed = ranked.join(F.broadcast(around), ranked["_g"].eqNullSafe(around["_g"])).drop(around["_g"])
    share = F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i"))
    position = (F.col("n") - 1) * share
    at = F.col("_before") + F.get("_below", F.col("_i"))
    picks = [F.max(F.when((at <= r) & (r < at + F.col("_c")), F.col("_v"))).alias(name) for r, name in ((F.floor(position), "_a"), (F.ceil(position), "_b"))]
    ends = [F.min(at).alias("_first"), F.max(at + F.col("_c")).alias("_last")]
    found = placed.groupBy("_g", "_i").agg(
        *picks, *ends, F.first("n").alias("n"), F.first(position).alias("_p"), F.first(F.get("_prev", F.col("_i"))).alias("_prev"),
        F.first(F.get("_next", F.col("_i"))).alias("_next"),
    )

    def at_rank(inner: str, rank: Column) -> Column:
        beside = F.when(rank == F.col("_first") - 1, F.col("_prev")).when(rank == F.col("_last"), F.col("_next"))
        return F.coalesce(inner, beside, F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))

    low, high = at_rank("_a", F.floor("_p")), at_rank("_b", F.ceil("_p"))
    each = found.select("_g", "n", "_i", (low + (high - low) * (F.col("_p") - F.floor("_p"))).alias("_q"))
    whole = each.groupBy("_g").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("_i", "_q"))).alias("_qs"))
    return whole.select(F.col("_g").alias(group), "n", F.transform("_qs", lambda x: x["_q"]).alias("quantiles"))


def rank_cuts(
    df: DataFrame, order: Sequence[str], fractions: Sequence[float], bucket: Column, groups: Sequence[str] = ()
) -> DataFrame:
    """Per group, the order key found at rank `int(n * fraction)` for each fraction: columns cut_0, cut_1, ...

    `bucket` is a coarse, order-preserving function of `order`. A histogram over it finds the one bucket that holds
    each cut; only rows of those buckets are ranked. A cut at rank 0 is NULL.
    """
    keyed = df.select(*groups, *order, bucket.alias("_bucket"))
    histogram = stored(keyed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n")), "histogram")
    by_bucket = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(START, -1)
    total = F.sum("_n").over(Window.partitionBy(*groups))
    targets = F.array(*[F.floor(F.col("_total") * F.lit(float(f))) for f in fractions])
    cumulative = histogram.select(
        *groups, "_bucket", "_n", F.coalesce(F.sum("_n").over(by_bucket), F.lit(0)).alias("_base"), total.alias("_total")
    ).withColumn("_targets", targets)
    boundary = cumulative.filter(
        F.exists("_targets", lambda t: (t > F.col("_base")) & (t <= F.col("_base") + F.col("_n")))
    ).drop("_n")
    inner = join_back(keyed, small_side(boundary), [*groups, "_bucket"], "inner")
    ranked = global_prefix(inner, order, groups=[*groups, "_bucket"])
    rank = F.col("_base") + F.col("before") + 1
    cuts = [
        F.max(F.when(rank == F.col("_targets")[i], F.struct(*order))).alias(f"cut_{i}") for i in range(len(fractions))
    ]
    return ranked.groupBy(*groups).agg(*cuts)


def long_keys(df: DataFrame, key: str, rows: int) -> DataFrame | None:
    """Keys with more than `rows` rows (there are few by construction), or None when there are none.

    Only such keys have to be cut; the count is aggregated map-side and reads one column.
    """
    found = stored(df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows).select(key), "long-keys")
    return None if found.isEmpty() else found


def _flag_long(df: DataFrame, long: DataFrame, key: str) -> DataFrame:
    return join_back(df, long.withColumn("_long", F.lit(True)), [key])


def _chunk_layout(df: DataFrame, key: str, halo: int, chunk_rows: int) -> DataFrame:
    """For each (key, bucket): its own chunk and the later chunks that need its rows as lead-in."""
    w = Window.partitionBy(key).orderBy("_bucket").rowsBetween(START, -1)
    counted = df.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
    placed = counted.withColumn("_base", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    end = F.col("_base") + F.col("_n")
    own = F.floor(F.col("_base") / chunk_rows)
    first = F.greatest(own + 1, F.floor(end / chunk_rows))
    last = F.floor((end + halo - 1) / chunk_rows)
    later = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    chunks = F.concat(F.array(own), later).alias("_chunks")
    return placed.select(key, "_bucket", "_n", "_base", own.alias("_own"), chunks)


def _split_hot_buckets(rows: DataFrame, key: str, order: Sequence[str], halo: int, chunk_rows: int) -> DataFrame:
    """Chunks by exact position for rows of buckets that are too large to stay whole."""
    placed = global_prefix(rows, order, groups=[key, "_bucket"])
    position = F.col("_base") + F.col("before")
    own, reach = F.floor(position / chunk_rows), F.floor((position + halo) / chunk_rows)
    chunks = F.when(reach > own, F.array(own, reach)).otherwise(F.array(own))
    return placed.withColumns({"_own": own, "_chunks": chunks}).drop("before", "total")


def in_chunks(
    df: DataFrame, key: str, order: Sequence[str], halo: int, chunk_rows: int | None = None, bucket_seconds: int = 60,
    hot_rows: int | None = None,
) -> DataFrame:
    """Cut each key's time line into chunks of about `chunk_rows` rows, each led in by at least `halo` earlier rows.

    Adds `_chunk` and `_lead` (TRUE for lead-in rows, to be dropped after the window). Trailing row frames of up to
    halo + 1 rows over (key, _chunk) give the same values as over the whole key. Keys of at most `chunk_rows` rows stay
    whole; longer ones are cut between time buckets, from counts alone. A bucket of more than `hot_rows` rows is cut
    inside, by exact positions, for which `order` (time first) has to be total.
    """
    size = max(chunk_rows or max(MAX_GROUP_ROWS, 8 * halo), halo, 1)
    limit = hot_rows or 10 * size
    first = F.lit(0).cast("long")
    long = long_keys(df, key, size)
    if long is None:
        return df.withColumns({"_chunk": first, "_lead": F.lit(False)})
    bucketed = _flag_long(df, long, key).withColumn(
        "_bucket", F.when(F.col("_long"), F.floor(epoch_seconds(order[0]) / bucket_seconds))
    )
    layout = small_side(_chunk_layout(bucketed.filter("_long"), key, halo, size))
    placed = join_back(bucketed, layout, [key, "_bucket"])
    if not layout.filter(F.col("_n") > limit).isEmpty():
        hot = F.coalesce(F.col("_n") > limit, F.lit(False))
        placed = placed.filter(~hot).unionByName(_split_hot_buckets(placed.filter(hot), key, order, halo, size))
    return (
        placed.withColumn("_chunk", F.explode(F.coalesce("_chunks", F.array(first))))
        .withColumn("_lead", F.col("_chunk") != F.coalesce("_own", first))
        .drop("_bucket", "_n", "_base", "_own", "_chunks", "_long")
    )


def rolling(
    df: DataFrame, key: str, ts: str, frames: Mapping[str, tuple[str, Column | str, int]], tie: Sequence[str] = (),
    chunk_rows: int | None = None, bucket_seconds: int = 60, hot_rows: int | None = None,
) -> DataFrame:
    """Trailing row-frame statistics: {output: (avg | std | max | sum, input, rows incl. the current one)}.

    The state of the last 2^k rows is that of the last 2^(k-1) merged with the one 2^(k-1) rows back, and a frame is tiled by
    such states without overlap. So a value touches only the frames that hold it, the result does not depend on the chunks, and
    the cost grows with the logarithm of the frame. One shuffle and one sort serve all outputs; the states of a chunk are arrays
    that are merged whole, as a window per doubling made rows of a hundred columns. NaN readings count as missing.
    Without `tie`, rows of one time are ordered by their hash; remove exact copies with `dedup` first where they may be many.
    """
    inputs: dict[str, str] = {}
    columns: dict[str, Column] = {}
    for _, source, _ in frames.values():
        name = str(source)
        if name not in inputs:
            inputs[name] = f"_x{len(inputs)}"
            value = (F.col(source) if isinstance(source, str) else source).cast("double")
            columns[inputs[name]] = F.when(~F.isnan(value), value)
    widest = max(rows for _, _, rows in frames.values())
    order = [ts, *(tie or ["_tie"])]
    total = df if tie else df.withColumn("_tie", F.xxhash64(*df.columns))
    walked = in_chunks(total, key, order, widest - 1, chunk_rows, bucket_seconds, hot_rows).withColumns(columns)

    # Among exact copies the lead-in rows come first.
    w = Window.partitionBy(key, "_chunk").orderBy(*order, F.desc("_lead"))
    needed = {x: [(name, fn, rows) for name, (fn, source, rows) in frames.items() if inputs[str(source)] == x] for x in columns}
    kept = [StructField(f.name, DoubleType()) if f.name in frames else f for f in df.schema.fields]
    schema = StructType([*kept, *[StructField(f, DoubleType()) for f in frames if f not in df.columns]])

    def chunk_figures(table: pa.Table) -> pa.Table:
        at = table.column("_at").to_numpy()
        table = table if (at[1:] > at[:-1]).all() else table.take(pa.array(np.argsort(at)))
        own = np.flatnonzero(~table.column("_lead").to_numpy())
        found = {name: figure for x, wanted in needed.items() for name, figure in _frame_figures(table.column(x).to_numpy(), wanted, own).items()}
        shown = table.take(pa.array(own))
        return pa.table([found[f.name] if f.name in found else shown.column(f.name) for f in schema.fields], names=schema.names)

    carried = [*[c for c in df.columns if c not in frames], *columns]
    # A frame's name may be a column's too; then its figures stand in that column's place.
    ranked = walked.withColumn("_at", F.row_number().over(w)).withColumns({"_key": F.col(key)})
    return ranked.select("_key", "_chunk", "_at", "_lead", *carried).groupBy("_key", "_chunk").applyInArrow(chunk_figures, schema)


_State = dict[str, np.ndarray]


def _merged(a: _State, b: _State, back: int) -> _State:
    """State of two neighbouring runs of rows, the earlier one that of `back` rows before; a run without readings has n = 0."""
    older, newer = ({k: v[:len(v) - back] for k, v in a.items()}, {k: v[back:] for k, v in b.items()})
    na, nb = older["n"], newer["n"]
    n = na + nb
    both = {"n": n}
    if "m" in a:
        gap = newer["m"] - older["m"]
        both["m"] = older["m"] + gap * nb / n
    if "q" in a:
        both["q"] = older["q"] + newer["q"] + gap * gap * na * nb / n
    if "s" in a:
        both["s"] = older["s"] + newer["s"]
    if "top" in a:
        both["top"] = np.maximum(older["top"], newer["top"])
    if not (na.all() and nb.all()):
        both = {k: v if k == "n" else np.where(na == 0, newer[k], np.where(nb == 0, older[k], v)) for k, v in both.items()}
    return {k: np.concatenate([b[k][:back], v]) for k, v in both.items()}


def _frame_figures(value: np.ndarray, wanted: Sequence[tuple[str, str, int]], own: np.ndarray) -> dict[str, pa.Array]:
    """{output: figures of the rows at `own`} for (output, avg | std | max | sum, rows) over the values in order, NaN where missing.

    The state of a run is its readings, sum, mean, squared deviations from the mean and greatest, as far as they are wanted.
    """
    parts = {part for _, fn, _ in wanted for part in {"avg": "sm", "std": "mq", "sum": "s", "max": ("top",)}[fn]}
    with np.errstate(all="ignore"):
        level = {"n": (~np.isnan(value)).astype(np.float64)}
        level |= {part: value - value if part == "q" else value for part in ("s", "m", "q", "top") if part in parts}
        sizes = sorted({rows for _, _, rows in wanted})
        tiles: dict[int, tuple[_State, int]] = {}
        for power in range(sizes[-1].bit_length()):
            run = 1 << power
            for rows in sizes:
                if rows & run:
                    newer, covered = tiles.get(rows, (None, 0))
                    tiles[rows] = (level if newer is None else _merged(level, newer, min(covered, len(value))), covered + run)
            if sizes[-1] >= 2 * run:
                level = _merged(level, level, min(run, len(value)))
        out = {}
        for name, fn, rows in wanted:
            state = {k: v[own] for k, v in tiles[rows][0].items()}
            if fn == "avg":  # With an infinity among the readings only the sum says on which side.
                figure = np.where(np.isnan(state["m"]), state["s"] / state["n"], state["m"])
            elif fn == "std":
                figure = np.sqrt(state["q"] / (state["n"] - 1))
            else:
                figure = state["top" if fn == "max" else "s"]
            out[name] = pa.array(figure, mask=state["n"] < (2 if fn == "std" else 1), from_pandas=False)
    return out


def forward_max(df: DataFrame, key: str, ts: str, value: Column, seconds: int, out: str) -> DataFrame:
    """Greatest `value` in [t, t + seconds] per key, added to every row.

    Rows of one second share their frame, so they are reduced first. The time line is cut into blocks as long as the
    frame: a frame is the rest of its own block plus the head of the next, two running maxima that cost the same for
    any frame length. No group exceeds twice the seconds of one block.
    """
    length = seconds + 1
    timed = df.withColumn("_sec", epoch_seconds(ts)).withColumn("_value", value)
    points = timed.groupBy(key, "_sec").agg(F.max("_value").alias("_value"))

    def mark(at: Column, probe: int, carried: Column) -> Column:
        return F.struct(
            F.floor(at / length).alias("_block"), at.alias("_at"), F.lit(probe).alias("_probe"), carried.alias("_value")
        )

    # Each point stands for itself and asks, as a probe, for the maximum up to the end of its frame.
    nothing = F.lit(None).cast(points.schema["_value"].dataType)
    marks = F.array(mark(F.col("_sec"), 0, F.col("_value")), mark(F.col("_sec") + seconds, 1, nothing))
    block = Window.partitionBy(key, "_block")
    head = F.max("_value").over(block.orderBy("_at", "_probe").rowsBetween(START, 0))
    rest = F.max("_value").over(block.orderBy(F.desc("_at"), F.desc("_probe")).rowsBetween(START, 0))
    halves = points.select(key, "_sec", F.inline(marks)).select(
        key, "_sec", F.when(F.col("_probe") == 1, head).otherwise(rest).alias("_value")
    )
    reach = halves.groupBy(key, "_sec").agg(F.max("_value").alias(out))
    return join_back(timed, reach, [key, "_sec"]).drop("_sec", "_value")


def as_of_join(
    left: DataFrame, right: DataFrame, key: str, ts: str, columns: Sequence[str], bucket_seconds: int = 60,
    whole_rows: int = MAX_GROUP_ROWS, hot_rows: int = 10 * MAX_GROUP_ROWS, tie: Sequence[str] = (),
) -> DataFrame:
    """Each left row with the right row of the same key that is newest at or before its time.

    Of right rows of one key and time, the one with the greatest `tie` columns, then the greatest `columns`, stands for all:
    the right side is reduced to it first, whatever its size.
    Both sides are united and walked in time order. Keys of more than `whole_rows` rows are walked per time bucket:
    what a bucket inherits from earlier ones - the last right row - is worked out on one row per bucket and enters as
    an extra first row, so neither a range join nor a sort of a long key is needed. When some bucket holds more than
    `hot_rows` rows, the left side too is reduced to one row per (key, time) and the matches are joined back.
    """
    kept = [c for c in left.columns if c not in (key, ts)]
    nothing = F.lit(None)
    right = right.groupBy(key, ts).agg(F.max(F.struct(F.struct(*tie, *columns).alias("t"), F.struct(*columns).alias("r")))["r"].alias("_r")).select(key, ts, "_r.*")
    right_type = right.select(F.struct(*columns).alias("f")).schema["f"].dataType
    lefts = left.select(
        key, ts, F.lit(2).alias("_kind"), nothing.cast(right_type).alias("_found"), F.struct(*kept).alias("_row")
        if kept else nothing.cast("int").alias("_row"),
    )
    row_type = lefts.schema["_row"].dataType
    rights = right.select(
        key, ts, F.lit(1).alias("_kind"), F.struct(*columns).alias("_found"), nothing.cast(row_type).alias("_row")
    )
    both = lefts.unionByName(rights)
    long = long_keys(both, key, whole_rows)
    if long is None:
        walked = both.withColumn("_bucket", F.lit(0))
    else:
        time_bucket = F.when(F.col("_long"), F.floor(epoch_seconds(ts) / bucket_seconds))
        walked = _flag_long(both, long, key).withColumn("_bucket", time_bucket)
        crowded = walked.filter("_long").groupBy(key, "_bucket").agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
        if hot_rows and not crowded.isEmpty():
            times = left.select(key, ts).distinct()
            matches = as_of_join(times, right, key, ts, columns, bucket_seconds, whole_rows, hot_rows=0)
            return join_back(left, matches, [key, ts]).select(key, ts, *kept, *columns)
        last = F.max_by("_found", F.when(F.col("_kind") == 1, F.col(ts))).alias("_found")
        before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(START, -1)
        inherited = (
            walked.filter("_long").groupBy(key, "_bucket").agg(last)
            .withColumn("_found", F.last("_found", ignorenulls=True).over(before))
            .filter(F.col("_found").isNotNull())
            .select(
                key, nothing.cast(left.schema[ts].dataType).alias(ts), F.lit(0).alias("_kind"), "_found",
                nothing.cast(row_type).alias("_row"), "_bucket",
            )
        )
        walked = walked.drop("_long").unionByName(inherited)
    walk = Window.partitionBy(key, "_bucket").orderBy(F.asc_nulls_first(ts), "_kind").rowsBetween(START, 0)
    matched = walked.withColumn("_found", F.last("_found", ignorenulls=True).over(walk)).filter(F.col("_kind") == 2)
    parts = [F.col(f"_row.{c}").alias(c) for c in kept]
    return matched.select(key, ts, *parts, *[F.col(f"_found.{c}").alias(c) for c in columns])
