import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from plantmetrics.operators import embeddings as E
from plantmetrics.operators import retrieval
from plantmetrics.operators import search as S

SCHEMA = "id long, embedding array<double>, kind string"


def clustered(n, seed, groups=12, d=8):
    random = np.random.default_rng(seed)
    middle = random.standard_normal((groups, d)) * 4
    return [(i, (middle[i % groups] + random.standard_normal(d) * 0.3).tolist(), "ab"[i % 2]) for i in range(n)]


def brute(corpus, queries, k, by_kind):
    out = {}
    for q, v, kind in queries:
        scores = []
        for c, w, have in corpus:
            if w is None or not any(w) or by_kind and kind is not None and have != kind:
                continue
            scores.append((-round(float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), 9), c))
        out[q] = [c for _, c in sorted(scores)[:k]]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.corpus_id)
    return out


@pytest.fixture(scope="module")
def corpus():
    rows = clustered(600, 1)
    copies = [(1000 + i, rows[7][1], "b") for i in range(200)]
    return rows + copies + [(5000, None, "a"), (5001, [0.0] * 8, "a")]


@pytest.mark.parametrize("by_kind", [False, True])
@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 100])
def test_answers_are_those_of_brute_force(spark, corpus, by_kind, broadcast_bytes):
    asked = [(i, v, [None, "a", "b"][i % 3]) for i, v, _ in clustered(30, 2)] + [(99, corpus[7][1], None)]
    filters = ["kind"] if by_kind else []
    index = S.build_index(spark.createDataFrame(corpus, SCHEMA), filters=["kind"])
    opened = []
    got = answers(S.search(index, spark.createDataFrame(asked, SCHEMA), 4, filters, broadcast_bytes=broadcast_bytes, opened_out=opened))
    assert got == brute(corpus, asked, 4, by_kind)
    assert index.rows.sum() == 800
    if opened and not by_kind:
        assert opened[0].sum() < 0.4 * opened[0].size  # Most cells stay shut.


def test_fewer_rows_than_wanted_and_empty_sides(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [0.0, 1.0], "b")]
    index = S.build_index(spark.createDataFrame(rows, SCHEMA), filters=["kind"])
    asked = spark.createDataFrame([(7, [1.0, 1.0], "a"), (8, [2.0, 1.0], None), (9, [0.0, 0.0], None), (10, None, None)], SCHEMA)
    assert answers(S.search(index, asked, 5, ["kind"])) == {7: [1], 8: [1, 2]}
    assert answers(S.search(index, asked, 5)) == {7: [1, 2], 8: [1, 2]}
    assert S.search(index, asked.limit(0), 3).count() == 0
    nothing = S.build_index(spark.createDataFrame([(1, None, "")], SCHEMA))
    assert S.search(nothing, asked, 3).count() == 0


def test_only_opened_cells_are_read(spark, corpus):
    index = S.build_index(spark.createDataFrame(corpus, SCHEMA))
    unit = S._unit(np.array([corpus[3][1]]))
    first = S.plan_cells(index, unit, 3)
    assert first.sum() == 1 and index.rows[first[0]].sum() >= 3
    asked = spark.createDataFrame(corpus[3:4], SCHEMA).toPandas()
    plan = S._scan(spark, index, asked, unit, first, 3, [])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [(cell" in plan or "PartitionFilters: [cell" in plan


def test_mask_of_the_best():
    scores = np.array([[1.0, 5], [3, 5], [3, 5], [-np.inf, 1], [3, -np.inf]])
    assert retrieval.best_rows(scores, 2).T.nonzero()[1].tolist() == [1, 2, 0, 1]
    assert retrieval.best_rows(scores, 9).sum() == 8 and retrieval.best_rows(np.zeros((0, 3)), 2).shape == (0, 3)


def words(text):
    return Counter(int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % E.DIMS for w in re.findall(r"[^\W_]+", (text or "").lower()))


def expected(rows):
    cells = {k: words(t) for k, t in rows}
    held = Counter(b for c in cells.values() for b in c)
    out = {}
    for k, c in cells.items():
        v = np.zeros(E.DIMS)
        for b, n in c.items():
            v[b] = n * ((len(rows) + 1) // (held[b] + 1)).bit_length()
        out[k] = v / (np.linalg.norm(v) or 1)
    return out


def made(index):
    rows = index.rows.collect()
    assert len({r.chunk_id for r in rows}) == len(rows)
    return {r.chunk_id: np.array(r.embedding) for r in rows}, {r.chunk_id: r.revision for r in rows}


TEXTS = [(i, f"pump {i % 5} seal leak unit{i} " + "bolt " * (i % 3)) for i in range(40)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "chunk_id long, content string")


def test_vectors_weigh_rare_words_more(spark):
    rows = [*TEXTS, (98, None), (99, "...")]
    vectors, _ = made(E.sync_index(frame(spark, rows)))
    for key, want in expected(rows).items():
        assert np.allclose(vectors[key], want, atol=1e-12)


def test_a_sync_equals_a_rebuild_and_leaves_unmoved_rows(spark):
    index = E.sync_index(frame(spark, TEXTS))
    later = [(k, t + " new" if k == 3 else t) for k, t in TEXTS if k != 5] + [(77, "fresh text about a pump")]
    synced = E.sync_index(frame(spark, later), index)
    vectors, revisions = made(synced)
    rebuilt = E.sync_index(frame(spark, later))
    again, _ = made(rebuilt)
    assert vectors.keys() == again.keys() and all(np.array_equal(vectors[k], again[k]) for k in again)
    counts = lambda i: sorted((r.bucket, r.texts) for r in i.counts.collect())
    assert counts(synced) == counts(rebuilt)
    assert revisions[3] == revisions[77] == 1
    old, new = E.weights(index.counts), E.weights(synced.counts)
    moved = {b for b in range(E.DIMS) if old[b] != new[b]}
    assert {k for k, r in revisions.items() if r == 1} == {3, 77} | {k for k, t in later if moved & set(words(t))}
    assert 0 in revisions.values()


def test_many_texts_more_move_the_weights(spark):
    index = E.sync_index(frame(spark, TEXTS))
    more = TEXTS + [(1000 + i, f"valve {i}") for i in range(60)]
    vectors, _ = made(E.sync_index(frame(spark, more), index))
    for key, want in expected(more).items():
        assert np.allclose(vectors[key], want, atol=1e-12)
    emptied, _ = made(E.sync_index(frame(spark, TEXTS).limit(0), index))
    assert emptied == {}


def test_a_sync_stores_cells_without_the_texts(spark, monkeypatch):
    kept = {}
    plain = E.stored
    monkeypatch.setattr(E, "stored", lambda df, label="side": kept.setdefault(label, plain(df, label)))
    rows = [("a", "Ring ring, bolt 7"), ("b", None), ("c", ""), ("d", "Ärger über 7 Ringe")]
    made = E.sync_index(spark.createDataFrame(rows, "chunk_id string, content string"))
    assert kept["cells"].columns == ["chunk_id", "content_hash", "cells"]
    found = {r.chunk_id: [c["count"] for c in r.cells] for r in made.rows.collect()}
    assert sorted(found["a"]) == [1, 1, 2] and found["b"] == found["c"] == [] and sum(found["d"]) == 4
