import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantmetrics.operators import governance, logs, retrieval, text


def vectors(spark, n, dims=8, seed=0, offset=0):
    rng = np.random.default_rng(seed)
    rows = [(offset + i, [float(x) for x in rng.normal(size=dims)], int(i % 3)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, embedding array<float>, kind int")


def brute_topk(corpus, queries, k, same_kind):
    out = {}
    for q, qv, qk in queries:
        scored = []
        for c, cv, ck in corpus:
            if same_kind and ck != qk:
                continue
            a, b = np.float32(qv).astype(float), np.float32(cv).astype(float)
            scored.append((-(a @ b) / np.linalg.norm(a) / np.linalg.norm(b), c))
        out[q] = [c for _, c in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("filters", [(), ("kind",)])
@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 200])
def test_topk_equals_brute_force_on_both_paths(spark, filters, broadcast_bytes):
    corpus_rows, corpus = vectors(spark, 120)
    query_rows, queries = vectors(spark, 11, seed=1, offset=1000)
    got = retrieval.topk_similar(corpus, queries, 3, filters, broadcast_bytes=broadcast_bytes, block_rows=30)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.corpus_id)
    assert found == brute_topk(corpus_rows, query_rows, 3, bool(filters))


def test_topk_ties_nulls_and_zero_vectors(spark):
    corpus = spark.createDataFrame([(3, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (4, [0.0, 1.0]), (5, None)], "id long, embedding array<float>")
    queries = spark.createDataFrame([(9, [5.0, 0.0]), (8, None)], "id long, embedding array<float>")
    got = [r.corpus_id for r in retrieval.topk_similar(corpus, queries, 4).orderBy("rank").collect()]
    assert got == [1, 3, 4]


def test_best_match_floor_and_blocks(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0])], "id int, v array<double>")
    refs = spark.createDataFrame([("east", [2.0, 0.1]), ("north", [0.1, 1.0])], "name string, c array<double>")
    got = {r.id: (r.matched, r.similarity_score > 0) for r in text.best_match(df, "v", refs, "name", "c").collect()}
    assert got == {1: ("east", True), 2: (None, False)}
    many = spark.range(3000).selectExpr("id AS name", "array(CAST(id AS double), 3000D - id) AS c")
    whole, cut = (text.best_match(df, "v", many, "name", "c", block_bytes=b).collect() for b in (1 << 20, 900))
    assert sorted(whole) == sorted(cut) and {r.id: r.matched for r in whole} == {1: 2999, 2: None}
    assert text.best_match(df, "v", refs.limit(0), "name", "c").filter("matched IS NULL").count() == 2


def test_similar_pairs_score_higher(spark):
    df = spark.createDataFrame([("spindle overheat", "spindle overheat alarm", "belt wear")], "a string, b string, c string")
    made = df
    for c in "abc":
        made = retrieval.embed_text(made, c, f"{c}_v")
    scored = text.pair_similarity(text.pair_similarity(made, "a_v", "b_v", "near"), "a_v", "c_v", "far").first()
    assert scored.near > scored.far


def test_classify_ties_and_default(spark):
    labels = {"first": ("x",), "second": ("y", "z")}
    df = spark.createDataFrame([("x y",), ("y z x",), ("none",), (None,)], "t string")
    assert [r.predicted for r in text.classify_text(df, "t", labels).collect()] == ["first", "second", "other", "other"]


def test_pareto_shares_running_value_between_equal_counts(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",)] * 2, "c string")
    got = {r.c: (r.row_count, r.cumulative) for r in text.pareto(df, "c").collect()}
    assert got == {"a": (3, 3), "b": (2, 7), "c": (2, 7)}


def test_extract_gives_null_where_absent(spark):
    df = spark.createDataFrame([("part: belt, minutes: 30",), ("nothing",)], "t string")
    rows = [r.info for r in text.extract_fields(df, "t").collect()]
    assert rows[0].replaced_part == "belt" and rows[0].work_minutes == "30" and rows[0].technician is None
    assert rows[1].replaced_part is None


def test_parse_output_fences_and_fallback(spark):
    good = json.dumps({"cause": "wear", "hours": 2})
    df = spark.createDataFrame([(good,), (f"```json\n{good}\n```",), (f"```\n{good}```",), ("sorry",), (None,)], "t string")
    fallback = {"cause": F.lit("unparsed"), "hours": F.lit(-1)}
    rows = text.parse_output(df, "t", "cause STRING, hours INT", fallback).collect()
    assert [r.parsed.cause for r in rows] == ["wear"] * 3 + ["unparsed"] * 2
    assert [r.parse_failed for r in rows] == [False] * 3 + [True] * 2


def test_page_chunks_order_and_markup(spark):
    def e(kind, content, page):
        return {"id": 1, "type": kind, "content": content, "bbox": [{"coord": [1], "page_id": page}] if page is not None else []}

    doc = json.dumps([e("title", "T", 0), e("text", "", 0), e("caption", "c", 0), e("section_header", "s", 1), e("text", None, 1), e("text", "b", 1)])
    df = spark.createDataFrame([(1, doc), (2, "broken")], "doc_id int, elements string")
    got = {(r.doc_id, r.page_id): r.content for r in retrieval.page_chunks(df, "elements", ["doc_id"]).collect()}
    assert got == {(1, 0): "# T\n*c*", (1, 1): "## s\nb"}


def test_html_tables_become_pipes_and_others_pass(spark):
    html = "<h1>A</h1><table><tr><td>x</td><td>y &amp; z</td></tr></table><img src='p.png'>"
    df = spark.createDataFrame([(html,), ("<p>kept</p>",), (None,)], "t string")
    rows = [r.t for r in retrieval.html_to_markdown(df, "t").collect()]
    assert rows[0].startswith("# A") and "|x |y & z |" in rows[0] and "<" not in rows[0]
    assert rows[1:] == ["<p>kept</p>", None]


def test_sync_embeds_only_new_and_changed(spark):
    old = spark.createDataFrame([("a", "one"), ("b", "two"), ("c", "three")], "chunk_id string, content string")
    now = spark.createDataFrame([("a", "one"), ("b", "TWO!"), ("d", "four")], "chunk_id string, content string")
    index = retrieval.sync_embeddings(old, None)
    changed = {r.chunk_id: r.change for r in retrieval.changed_chunks(now, index).collect()}
    assert changed == {"b": "changed", "c": "vanished", "d": "new"}
    marked = index.withColumn("embedding", F.array(F.lit(7.0).cast("float")))
    synced = {r.chunk_id: r.embedding for r in retrieval.sync_embeddings(now, marked).collect()}
    assert sorted(synced) == ["a", "b", "d"] and synced["a"] == [7.0] and len(synced["b"]) == 256
    full = {r.chunk_id: r.embedding for r in retrieval.sync_embeddings(now, None).collect()}
    assert synced["d"] == full["d"]


def test_hybrid_context_says_when_data_is_missing(spark):
    latest = spark.createDataFrame([("EQ001", "CNC", 70.0, 2.5, 5.0, 900.0, True)], "equipment_id string, equipment_type string, temperature_c double, vibration_ms2 double, pressure_bar double, rpm double, is_anomaly boolean")
    asked = spark.createDataFrame([(1, "EQ001"), (2, "EQ002")], "query_id int, equipment_id string")
    contexts = spark.createDataFrame([(1, "manual")], "query_id int, context string")
    got = {r.query_id: r for r in retrieval.hybrid_context(asked, contexts, latest).collect()}
    assert "ANOMALY" in got[1].sensor_context and got[2].sensor_context == "no sensor data" and got[2].manual_context is None


def test_threads_stay_apart_and_in_order(spark):
    rows = [(1, 2, "assistant", ""), (1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 3, "assistant", "a"), (2, 0, "user", "yo")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = {r.conv_id: [tuple(m) for m in r.messages] for r in logs.assemble_threads(df).collect()}
    assert got == {1: [("system", "s"), ("user", "hi"), ("assistant", ""), ("assistant", "a")], 2: [("user", "yo")]}
    assert {r.conv_id: r.session_key for r in logs.session_keys(df).collect()} == {1: "hi", 2: "yo"}
    assert {r.conv_id: r.answer for r in logs.last_answer(df).collect()} == {1: "a"}
    assert {r.conv_id: r.speakers for r in logs.speakers(df, "system").collect()} == {1: ["user", "assistant"], 2: ["user"]}


def test_latest_runs_default_state(spark):
    rows = [("j", datetime(2024, 1, i), None if i == 3 else "SUCCESS") for i in range(1, 8)]
    df = spark.createDataFrame(rows, "job string, at timestamp_ntz, state string")
    got = [(r.rank, r.state) for r in logs.latest_runs(df, "job", "at", "state").orderBy("rank").collect()]
    assert got == [(1, "SUCCESS"), (2, "SUCCESS"), (3, "SUCCESS"), (4, "SUCCESS"), (5, "RUNNING")]


def test_masks(spark):
    df = spark.createDataFrame([("EM12345",)], "employee_id string")
    assert governance.mask(df, "employee_id", ["analyst"]).first()[0] == "EM***"
    assert governance.mask(df, "employee_id", ["admin"]).first()[0] == "EM12345"
    governance.register_mask(spark, "mask_test", ["analyst"])
    assert df.selectExpr("mask_test(employee_id)").first()[0] == "EM***"
