import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plantmetrics.operators import changes

SCHEMA = "k int, v string, n int"
STAMP = "2024-01-0{} 00:00:00"


def snapshot(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_updates_and_inserts_listed_columns_only(spark):
    target = snapshot(spark, [(1, "a", 10), (2, "b", 20)])
    source = snapshot(spark, [(2, "B", 99), (3, "C", 30)])
    got = changes.merge_upsert(target, source, ["k"], update=["v"], insert=["n"])
    assert as_set(got) == [(1, "a", 10), (2, "B", 20), (3, None, 30)]
    assert as_set(changes.merge_upsert(target, source, ["k"])) == [(1, "a", 10), (2, "B", 99), (3, "C", 30)]


def test_upsert_with_null_values_is_not_taken_for_a_missing_row(spark):
    target = snapshot(spark, [(1, None, None)])
    source = snapshot(spark, [(1, "x", None), (2, None, None)])
    assert as_set(changes.merge_upsert(target, source, ["k"])) == [(1, "x", None), (2, None, None)]


def test_upsert_fails_on_a_repeated_source_key(spark):
    target = snapshot(spark, [(1, "a", 10)])
    with pytest.raises(Exception, match="repeats"):
        changes.merge_upsert(target, snapshot(spark, [(1, "x", 1), (1, "y", 2)]), ["k"]).collect()


def test_feed_of_equal_snapshots_is_empty(spark):
    same = snapshot(spark, [(1, "a", None), (2, None, 2)])
    assert changes.change_feed(same, same, ["k"], 1, STAMP.format(1)).count() == 0


def test_feed_fails_on_repeated_keys(spark):
    twice = snapshot(spark, [(1, "a", 1), (1, "b", 2)])
    with pytest.raises(Exception, match="repeats"):
        changes.change_feed(twice, snapshot(spark, [(1, "a", 1)]), ["k"], 2, STAMP.format(2)).collect()


def test_log_replays_every_version_and_restore_returns_to_it(spark):
    rng = random.Random(3)
    versions = [{k: (k, rng.choice("abc"), k) for k in range(40)}]
    for _ in range(3):
        now = dict(versions[-1])
        for k in rng.sample(range(60), 15):
            if rng.random() < 0.4:
                now.pop(k, None)
            else:
                now[k] = (k, rng.choice("abcd"), rng.randrange(5))
        versions.append(now)
    frames = [snapshot(spark, list(v.values())) for v in versions]
    log = changes.initial_load(frames[0], 1, STAMP.format(1))
    for i in range(1, 4):
        log = log.unionByName(changes.change_feed(frames[i - 1], frames[i], ["k"], i + 1, STAMP.format(i + 1)))
    for i in range(4):
        assert as_set(changes.state_as_of(log, ["k"], version=i + 1)) == sorted(versions[i].values())
    assert as_set(changes.state_as_of(log, ["k"], timestamp="2024-01-02 10:00:00")) == sorted(versions[1].values())
    back = changes.restore(log, ["k"], 1, 5, STAMP.format(5))
    assert as_set(changes.state_as_of(back, ["k"])) == sorted(versions[0].values())
    kept = changes.expire_changes(log, ["k"], "2024-01-03 12:00:00", hours=24)
    assert kept.count() < log.count()
    assert as_set(changes.state_as_of(kept, ["k"])) == sorted(versions[3].values())
    assert as_set(changes.state_as_of(kept, ["k"], version=3)) == sorted(versions[2].values())


def test_delete_keeps_rows_with_null_condition(spark):
    df = snapshot(spark, [(1, "a", None), (2, "b", 5), (3, "c", 1)])
    assert sorted(r.k for r in changes.delete_where(df, "n > 2").collect()) == [1, 3]


def test_new_rows_after_the_high_watermark(spark):
    rows = [(i, datetime(2024, 1, i)) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz")
    assert sorted(r.k for r in changes.new_rows(df, df.filter("k <= 3"), "ts").collect()) == [4, 5]
    assert changes.new_rows(df, df.filter("k > 9"), "ts").count() == 5


def test_incremental_load_states_and_dedup(spark):
    schema = "event_id int, temperature_c double, vibration_ms2 double"
    base = spark.createDataFrame([(1, 50.0, 1.0), (2, 500.0, 1.0)], schema)
    log = changes.initial_load(base, 1, STAMP.format(1))
    marks = spark.createDataFrame([], "pipeline_name string, last_processed_version long, updated_at timestamp_ntz")
    empty = base.filter("event_id < 0")
    done = changes.incremental_clean(log, empty, marks, "p", STAMP.format(2))
    assert [r.event_id for r in done.target.collect()] == [1]
    assert done.status.first().status == "processed"
    assert [(r.pipeline_name, r.last_processed_version) for r in done.checkpoints.collect()] == [("p", 1)]
    again = changes.incremental_clean(log, done.target, done.checkpoints, "p", STAMP.format(3))
    assert again.status.first().status == "up_to_date" and again.target.count() == 1
    assert [r.last_processed_version for r in again.checkpoints.collect()] == [1]
    deleted = log.unionByName(changes.change_feed(base, base.filter("event_id = 1"), ["event_id"], 2, STAMP.format(2)))
    assert changes.incremental_clean(deleted, done.target, done.checkpoints, "p", STAMP.format(3)).status.first().status == "no_inserts"
    restored = changes.restore(
        changes.initial_load(base, 1, STAMP.format(1)).unionByName(
            changes.change_feed(base, empty, ["event_id"], 2, STAMP.format(2))), ["event_id"], 1, 3, STAMP.format(3))
    twice = changes.incremental_clean(restored, done.target, done.checkpoints, "p", STAMP.format(4))
    once = changes.incremental_clean(restored, done.target, done.checkpoints, "p", STAMP.format(4), dedup_keys=["event_id"])
    assert twice.target.count() == 2 and once.target.count() == 1


def test_history_and_summary(spark):
    a, b = snapshot(spark, [(1, "a", 1), (2, "b", 2)]), snapshot(spark, [(1, "z", 1)])
    log = changes.initial_load(a, 1, STAMP.format(1)).unionByName(changes.change_feed(a, b, ["k"], 2, STAMP.format(2)))
    got = {r._change_type: (r.first_version, r.latest_version) for r in changes.history_summary(log).collect()}
    assert got == {"insert": (1, 2), "delete": (2, 2), "update_preimage": (2, 2), "update_postimage": (2, 2)}
    assert changes.change_summary(log).agg(F.sum("row_count")).first()[0] == log.count() == 5
    assert changes.changes_between(log, 2, 2, ["delete"]).count() == 1


def lines_above(plan: str, leaf: str) -> list[list[str]]:
    """Operators above every scan whose line holds `leaf`, from the indented plan text."""
    above, found = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*("))
        above = [(d, n) for d, n in above if d < depth]
        if leaf in line:
            found.append([n for _, n in above])
        above.append((depth, line.strip()))
    return found


def test_upsert_leaves_the_bulk_of_the_target_where_it_is(spark, tmp_path):
    spark.range(5000).selectExpr("CAST(id AS INT) AS k", "'a' AS v", "1 AS n").write.parquet(f"{tmp_path}/bulk")
    target = spark.read.parquet(f"{tmp_path}/bulk")
    source = snapshot(spark, [(7, "x", 2), (9000, "y", 3)])
    got = changes.merge_upsert(target, source, ["k"])
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert got.count() == 5001 and as_set(got.filter("n > 1")) == [(7, "x", 2), (9000, "y", 3)]
    flagged = changes.flag_possible(target, source, ["k"])
    assert flagged.filter("_possible").count() == 1
    plan = flagged.filter("NOT _possible")._jdf.queryExecution().executedPlan().toString()
    paths = lines_above(plan, "bulk")
    assert paths and not any("Exchange" in n for p in paths for n in p)


def test_upsert_with_few_bits_null_keys_and_many_rows(spark):
    rng = random.Random(1)
    target = {k: (k, rng.choice("ab"), k) for k in rng.sample(range(500), 200)}
    source = {k: (k, "S", -k) for k in rng.sample(range(500), 90)}
    with_null = snapshot(spark, [*target.values(), (None, "kept", 0)])
    for bits in (64, 1 << 23):
        got = changes.merge_upsert(with_null, snapshot(spark, [*source.values(), (None, "new", 1)]), ["k"], bits=bits)
        want = [*{**target, **source}.values(), (None, "kept", 0), (None, "new", 1)]
        assert sorted(map(str, as_rows(got))) == sorted(map(str, want))


def as_rows(df):
    return [tuple(r) for r in df.collect()]


def test_restore_reads_only_the_tail_and_no_key_twice(spark, tmp_path):
    v1 = snapshot(spark, [(k, "a", k) for k in range(30)])
    v2 = snapshot(spark, [(k, "b" if k == 3 else "a", k) for k in range(30) if k != 4])
    v3 = snapshot(spark, [(k, "c" if k == 3 else "a", k) for k in range(31) if k not in (4, 5)])
    v4 = snapshot(spark, [(k, "a", k) for k in range(30) if k != 4])
    log = changes.initial_load(v1, 1, STAMP.format(1))
    for i, (before, after) in enumerate(((v1, v2), (v2, v3), (v3, v4)), 2):
        log = log.unionByName(changes.change_feed(before, after, ["k"], i, STAMP.format(i)))
    log.write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    for version, want in ((1, v1), (2, v2), (3, v3), (4, v4)):
        restored = changes.restore(log, ["k"], version, 5, STAMP.format(5))
        assert as_set(changes.state_as_of(restored, ["k"])) == as_set(want), version
        # Key 3 went b, c, a: back to version 1 it did not change at all.
        assert restored.filter("_commit_version = 5 AND k = 3").count() == {1: 0, 2: 2, 3: 2, 4: 0}[version]
    tail = changes.restore(log, ["k"], 2, 5, STAMP.format(5)).filter("_commit_version = 5")
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1 and "GreaterThan(_commit_version,2)" in plan


def test_restore_fails_on_a_version_that_is_not_the_greatest_and_keeps_rows_without_one(spark):
    before, after = snapshot(spark, [(1, "a", 1), (2, "a", 2)]), snapshot(spark, [(1, "b", 1)])
    log = changes.initial_load(before, 1, STAMP.format(1)).unionByName(changes.change_feed(before, after, ["k"], 3, STAMP.format(3)))
    for taken in (2, 3):
        with pytest.raises(Exception, match=f"the log has version 3, not before {taken}"):
            changes.restore(log, ["k"], 1, taken, STAMP.format(4)).collect()
    loose = log.unionByName(log.limit(1).withColumn("_commit_version", F.lit(None).cast("long")))
    restored = changes.restore(loose, ["k"], 1, 4, STAMP.format(4))
    assert restored.filter("_commit_version IS NULL").count() == 1
    assert as_set(restored.filter("_commit_version < 4")) == as_set(log)
    assert as_set(changes.state_as_of(restored.filter("_commit_version IS NOT NULL"), ["k"])) == as_set(before)
