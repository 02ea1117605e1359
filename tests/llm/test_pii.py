import hashlib
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plantmetrics.llm import boosting as B
from plantmetrics.llm import pii as P

DOCS = "doc_id long, text string, spans string, kind string"
PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    d = [int(c) for c in digits]
    for i in range(len(d) - 2, -1, -2):
        d[i] = d[i] * 2 if d[i] < 5 else d[i] * 2 - 9
    return sum(d) % 10 == 0


def plain(text):
    """Base spans by the patterns as they are written down."""
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == 2 and 12 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


PIECES = st.lists(st.sampled_from(["a@b.co", "x.y", "@", ".", "+1", " ", "-", "(555)", "4485275742308327", "0", "12", "255", "300.1.2", "1.2.3.4", "é", "+", "_@", "a-b", "\n"]), max_size=14)


@settings(deadline=None, max_examples=400)
@given(st.one_of(PIECES.map("".join), st.text(alphabet="a@.1+- ()2é", max_size=40)))
def test_base_spans_are_those_of_the_patterns(text):
    assert P.base_matches(text)[0] == plain(text)


def card(r):
    body = "4" + "".join(r.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c))


def corpus(n, seed):
    r = random.Random(seed)
    rows = []
    for key in range(n):
        words = ["".join(r.choice(["lo", "re", "mi", "sa", "tu"]) for _ in range(r.randint(1, 4))) for _ in range(40)]
        for _ in range(2):
            ok = card(r)
            phone = f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
            words.insert(r.randrange(40), r.choice([
                f"{words[0]}.{r.randint(0, 99)}@mail.example.com", ".".join(str(r.randint(1, 255)) for _ in range(4)), ok,
                ok[:-1] + str((int(ok[-1]) + 3) % 10), phone, f"order {r.randint(10**6, 10**9)}", "version 4.0.1",
                f"token = \"{hashlib.sha1(str(r.random()).encode()).hexdigest()}\"",
            ]))
        rows.append((key, " ".join(words), "", ""))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return P.fit(spark.createDataFrame(corpus(900, 1), DOCS))


def spans(text, model):
    return [(P.KINDS[k], text[s:e], b) for s, k, e, _, b in P.spans_of(text, model)]


def test_base_stays_and_hidden_spans_are_found(model):
    r = random.Random(5)
    right = wrong = 0
    for key, text, *_ in corpus(200, 2):
        got = P.spans_of(text, model)
        assert sorted((s, k, e) for s, k, e, _, b in got if b) == plain(text)
        wrong += any(not b and k != P.SECRET for s, k, e, _, b in got)
    for _ in range(100):  # Two cards in one run, and a phone number followed by an address: the base drops both.
        two, phone = (card(r), card(r)), f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
        text = f"lore mi {two[0]} {two[1]} sa re {phone} 170.106.47.{r.randint(10, 99)} tu"
        got = [s[:2] for s in spans(text, model)]
        right += ("card", two[0]) in got and ("card", two[1]) in got and ("phone", phone) in got
    assert right >= 90 and wrong <= 4


def test_numbers_without_a_check_digit_are_left_alone(model):
    r = random.Random(6)
    taken = 0
    for _ in range(100):
        ok = card(r)
        taken += bool(spans(f"lore mi {ok[:-1]}{(int(ok[-1]) + 1) % 10} sa", model))
    assert taken <= 3 and spans("sa version 4.0.1 lore order 12345678 tu", model) == []


def test_result_does_not_depend_on_partitions(spark, model):
    again = P.fit(spark.createDataFrame(corpus(900, 1), DOCS).repartition(7))
    assert again.thresholds == model.thresholds and np.array_equal(again.trees.leaves, model.trees.leaves)


def test_training_rows_are_bounded_per_kind_and_label(frame):
    docs = frame(corpus(300, 3), DOCS)
    whole, few = P.training_rows(docs).collect(), P.training_rows(docs, per_class=9).collect()
    for kind in range(5):
        for label in (False, True):
            names = sorted(bytes(r.name) for r in whole if (r.kind, r.label) == (kind, label))
            assert sorted(bytes(r.name) for r in few if (r.kind, r.label) == (kind, label)) == names[:9]


def test_selected_spans_do_not_overlap(model):
    for _, text, *_ in corpus(150, 9):
        found = [s for s in P.spans_of(text + " " + text, model)]
        extra = [s for s in found if not s[4]]
        assert all(a is b or a[2] <= b[0] or b[2] <= a[0] for a in extra for b in found)


def test_boosted_trees_learn_a_pattern_that_needs_two_features():
    random_ = np.random.default_rng(1)
    rows = random_.random((3000, 6)).astype(np.float32)
    labels = ((rows[:, 1] > 0.5) ^ (rows[:, 4] > 0.3)).astype(float)
    trees = B.boost(rows[:2000], labels[:2000])
    assert ((trees.margins(rows[2000:]) > 0) == labels[2000:]).mean() > 0.95
    same = B.boost(np.zeros((4, 2), np.float32), np.array([1.0, 0, 1, 1]))
    assert np.allclose(B.sigmoid(same.margins(np.zeros((2, 2)))), 0.75, atol=0.02)
    assert B.boost(np.zeros((0, 3), np.float32), np.zeros(0)).margins(np.zeros((1, 3))).shape == (1,)


def test_long_texts_take_linear_time(model):
    begin = time.time()
    for piece in ("a", "1", "1.", "1 ", "@", "a@", "+1(", "aB3", "a.", "((", "+"):
        P.spans_of(piece * (100_000 // len(piece)), model)
    assert time.time() - begin < 60
    tail = "x" * 300_000 + " joe@mail.example.com"
    assert spans(tail, model)[-1] == ("email", "joe@mail.example.com", True)


def test_redaction(frame, model):
    rows = [(1, "a joe@mail.example.com, b 1.2.3.4", "k", "z"), (2, None, None, None), (None, "", "", ""), (4, "1.2.3.4", "", ""), (4, "1.2.3.4", "", "")]
    got = P.redact(frame(rows, DOCS), model).collect()
    assert [r.text for r in got] == ["a <EMAIL>, b <IP>", None, "", "<IP>", "<IP>"] and got[0].spans == "k"
    assert P.redacted("ab12cd", [(1, 0, 3, 1.0, True), (2, 1, 4, 1.0, True)]) == "a<EMAIL>cd"


def test_defined_cases(frame):
    rows = [(1, None, "", ""), (2, "", "", ""), (None, "no data here", "", ""), (3, "é 1.2.3.4", "", "")]
    model = P.fit(frame(rows, DOCS))
    got = {r.doc_id: [(s.kind, s.start, s.end, s.base) for s in r.spans] for r in P.find(frame(rows, DOCS), model).collect()}
    assert got == {1: [], 2: [], None: [], 3: [("ip", 2, 9, True)]}
    empty = frame([], DOCS)
    assert P.find(empty, P.fit(empty)).count() == 0


def test_every_candidate_is_learnt_from(spark):
    """At least 1,500 numbers of one kind and label: all are counted."""
    docs = spark.createDataFrame([(k, f"call {k} +1 ({200 + k % 700}) 555-{1000 + k} now, order {10**7 + 31 * k}", "", "") for k in range(1500)], DOCS)
    counted = P.counted_rows(P.training_rows(docs))
    many = {r.label: r.many for r in counted.groupBy("label").agg({"many": "sum"}).withColumnRenamed("sum(many)", "many").collect()}
    assert many[True] >= 1500 and many[False] >= 1500 and sum(many.values()) == P.training_rows(docs).count()


def test_trees_of_counted_rows_are_those_of_plain_rows(spark):
    random_ = np.random.default_rng(3)
    rows = random_.integers(0, 6, (400, 5)).astype(np.float32)
    labels = ((rows[:, 1] > 2) ^ (rows[:, 4] > 3)) | (random_.random(400) < 0.05)
    edges = np.tile(np.arange(5) + 0.5, (5, 1))
    bins = B.binned(rows, edges)
    counted = spark.createDataFrame(
        [(bool(y), int(k % 2), bytearray(b.tobytes()), 1) for k, (b, y) in enumerate(zip(bins, labels))], "label boolean, fold int, bins binary, many long"
    )
    first, _, whole = B.boost_counted(counted, edges, 2, rounds=5, depth=3)
    assert np.allclose(whole.margins(rows), B.boost(rows, labels.astype(float), rounds=5, depth=3).margins(rows), atol=1e-3)
    odd = np.arange(400) % 2 == 1
    assert np.allclose(first.margins(rows), B.boost(rows[odd], labels[odd].astype(float), rounds=5, depth=3).margins(rows), atol=1e-3)


def test_a_level_is_one_job_however_the_rows_are_cut(spark):
    """Before, a job was started for each part of the rows, or for each shuffle partition, at every level."""
    random_ = np.random.default_rng(4)
    rows = [(bool(k % 3 == 0), k % 2, bytearray(random_.integers(0, 6, 5).astype(np.uint8).tobytes()), 1 + k % 4) for k in range(300)]
    whole = spark.createDataFrame(rows, "label boolean, fold int, bins binary, many long")
    edges, context, margins = np.tile(np.arange(5) + 0.5, (5, 1)), spark.sparkContext, []
    some = random_.integers(0, 6, (50, 5)).astype(np.float32)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for parts, most in ((7, 2 + 4), (20, 2 + 2 * 4)):
            counted = whole.repartition(parts).localCheckpoint()
            context.setJobGroup(f"levels-{parts}", "")
            margins += [m.margins(some) for m in B.boost_counted(counted, edges, 2, rounds=2, depth=2)]
            assert len(context.statusTracker().getJobIdsForGroup(f"levels-{parts}")) <= most
            context.setJobGroup("other", "")
            assert len(spark.read.parquet(*B.packed(counted).inputFiles()).inputFiles()) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        context.setLocalProperty("spark.jobGroup.id", None)
    assert np.array_equal(margins[:3], margins[3:])
