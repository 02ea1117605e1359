import random

import numpy as np
import pyarrow as pa
import pytest

from plantmetrics.llm import quality_knn as K

SCHEMA = "doc_id long, text string, score string"


def texts(n, seed):
    """(key, text, label): calm sentences are good, shouting and stuttering are not."""
    random.seed(seed)
    out = []
    for key in range(n):
        words = ["".join(random.choice(["an", "be", "cor", "du", "el", "fi"]) for _ in range(random.randint(1, 4))) for _ in range(random.randint(20, 90))]
        good = key % 3 > 0
        kind = random.randrange(3)
        if not good:
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + "$%&" for w in words] if kind == 1 else [w for w in words[:9] for _ in range(8)]
        out.append((key, " ".join(words), int(good)))
    return out


@pytest.fixture(scope="module")
def taught(spark):
    rows = texts(300, 1)
    docs = spark.createDataFrame([(k, t, "") for k, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(k, g, 9) for k, _, g in rows] + [(None, 1, 9), (0, None, 9), (10**6, 0, 9)], "doc_id long, quality int, text int")
    return K.fit(docs, labels)


def test_new_texts(spark, taught):
    rows = texts(240, 2)
    scores = {r.doc_id: r.score for r in K.score(spark.createDataFrame([(k, t, "") for k, t, _ in rows], SCHEMA), taught).collect()}
    right = [(scores[k] >= 0.5) == bool(g) for k, _, g in rows]
    assert np.mean(right) > 0.97 and all(0 <= s <= 1 for s in scores.values())


def test_votes_are_those_of_all_pairs(taught):
    found = K.features(pa.array([t for _, t, _ in texts(40, 3)]))
    cosine = K._unit((found * taught.weights) @ taught.projection) @ taught.vectors.T
    for row, score in zip(cosine, K.votes(taught, found, block=7), strict=True):
        near = np.argsort(-row, kind="stable")[:taught.neighbours]
        weight = ((1 + row[near].astype(float)) / 2) ** taught.sharpness
        assert score == pytest.approx(float((weight * taught.labels[near]).sum() / weight.sum()), abs=1e-4)


def test_defined_cases(spark, taught):
    rows = [(1, None, ""), (2, "", ""), (None, "calm words here", ""), (3, "x" * 3_000_000, ""), (4, "same", ""), (4, "same", "")]
    got = K.score(spark.createDataFrame(rows, SCHEMA), taught).collect()
    assert len(got) == 6 and [r.score for r in got if r.doc_id in (1, 2)] == [taught.prior] * 2
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert K.score(spark.createDataFrame([], SCHEMA), taught).count() == 0


def test_long_texts_are_read_whole(monkeypatch):
    column = pa.array(["ab cd! " * 900])
    whole = K.features(column)
    monkeypatch.setattr(K, "_PIECE", 50)
    assert np.allclose(whole, K.features(column))


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "")], SCHEMA)
    model = K.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r.score for r in K.score(docs, model).collect()] == [0.5]


def test_kept_rows_keep_their_columns(spark, taught):
    rows = texts(60, 4)
    docs = spark.createDataFrame([(k, "s", t) for k, t, _ in rows], "doc_id long, score string, text string")
    kept = K.keep_good(docs, taught)
    assert kept.columns == docs.columns
    good = {k for k, _, g in rows if g}
    found = {r.doc_id for r in kept.collect()}
    assert good <= found and len(found - good) <= 2


def test_sample_is_bounded(spark):
    rows = texts(80, 5)
    docs = spark.createDataFrame([(k, t, "") for k, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(k, g) for k, _, g in rows], "doc_id long, quality int")
    assert len(K.fit(docs, labels, max_labelled=30).vectors) == 30
