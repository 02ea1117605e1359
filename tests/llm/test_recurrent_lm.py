import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plantmetrics.llm import recurrent as R
from plantmetrics.llm import recurrent_lm as L
from plantmetrics.llm import words as W

SCHEMA = "doc_id long, text string, score int"


def network(seed=0, window=6, slots=3):
    shape = R.Shape(inputs=7, classes=4, head_classes=2, hidden=5, window=window, slots=slots)
    random = np.random.default_rng(seed)
    return R.Network(shape, {k: random.standard_normal(v) * 0.5 for k, v in shape.parts().items()})


def tokens(lengths, seed=1):
    random = np.random.default_rng(seed)
    n = sum(lengths)
    return np.array(lengths), random.integers(0, 7, n), random.integers(0, 4, n), random.integers(0, R.HEAD_CLASS, n)


def test_gradients():
    net, data = network(), tokens([6, 5, 6])
    seen = {}
    net._step = lambda grads: seen.update({k: v.copy() for k, v in grads.items()})
    net.run(*data, learn=True)
    random = np.random.default_rng(2)
    for name, values in net.w.items():
        for _ in range(5):
            at = tuple(random.integers(0, s) for s in values.shape)
            old, loss = values[at], []
            for step in (1e-4, -1e-4):
                values[at] = old + step
                loss.append(-net.run(*data, learn=False).sum() / 17)
            values[at] = old
            assert seen[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-4, abs=1e-4)


def test_a_text_is_scored_whole_wherever_it_lies():
    lengths = [1, 40, 0, 7, 13, 2, 100]
    data = tokens(lengths)
    whole = network(window=1000, slots=100).run(*data, learn=False)
    for window, slots in ((4, 2), (1, 1), (16, 3)):
        assert np.allclose(whole, network(window=window, slots=slots).run(*data, learn=False), atol=1e-5)
    at = np.cumsum([0, *lengths])
    alone = network(slots=1).run(np.array([40]), *[x[at[1]:at[2]] for x in data[1:]], learn=False)
    assert np.allclose(whole[at[1]:at[2]], alone, atol=1e-5)


def corpus(n, seed):
    """Texts of one of two vocabularies each, so that context helps."""
    random.seed(seed)
    out = []
    for key in range(n):
        kind = random.choice("pq")
        out.append((key, " ".join(f"{kind}{int(random.expovariate(0.05))}" for _ in range(random.randint(0, 120))), 0))
    return out


def words(text):
    return (text or "").lower().split() + ["\n"]


def test_base_columns_and_better_than_base(spark):
    rows = corpus(400, 1) + [(9001, None, 0), (9002, "", 0), (9003, "never Seen words q1 q1", 0), (9003, "never Seen words q1 q1", 0), (None, "p1 P2", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    training = F.coalesce(F.col("doc_id") % 4 != 1, F.lit(True)) & ~F.coalesce(F.col("doc_id") == 9003, F.lit(False))
    got = L.fit_and_score(docs, training).collect()
    seen = Counter()
    for key, text, _ in rows:
        if key is None or key % 4 != 1 and key != 9003:
            seen.update(words(text))
    n, v = sum(seen.values()), len(seen)
    by_key = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for key, text, _ in rows:
        r = by_key[key]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words(text)), sum(seen[w] > 0 for w in words(text)), n)
        assert r.base_score == pytest.approx(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in words(text)), rel=1e-9)
    held = [r for r in got if r.doc_id and r.doc_id < 9000 and r.doc_id % 4 == 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert len({r.score for r in got if r.doc_id == 9003}) == 1


def test_chances_add_up(spark):
    """Over every known word and one unknown, after the same beginning, with a vocabulary smaller than the words."""
    docs = spark.createDataFrame([(k, t, 0) for k, t, _ in corpus(120, 3)], SCHEMA)
    counts = L.count_words(docs)
    made, class_bias, word_bias = L.build_vocabulary(docs, counts, vocabulary=70, grouped=50, head=40)
    weights = L.train(docs, made, R.flat(R.start(made.shape, class_bias, word_bias)), F.lit(0), rounds=1)
    known = sorted({w for _, t, _ in corpus(120, 3) for w in words(t)} - {"\n"})
    texts = [(k, f"p1 q2 {w}", 0) for k, w in enumerate([*known, "unknown"])] + [(-1, "p1 q2", 0)]
    rows = {r.doc_id: r for r in L.score(spark.createDataFrame(texts, SCHEMA), made, weights, counts).collect()}
    net = R.Network(made.shape, R.shaped(weights, made.shape))

    def before(text):
        """log10 chance of the words of a text without its end, from the score and the end's own chance."""
        import pyarrow as pa

        hashes, lengths = L.tokens_of(pa.array([text]))
        at, inside, inputs, classes, members = L._ids(made, hashes)
        log_p = net.run(lengths, inputs, classes, members, learn=False)
        return (log_p[-1] + made.shares[at[-1]]) / math.log(10)

    start = rows[-1].score - before("p1 q2")
    total = sum(10 ** (rows[k].score - before(f"p1 q2 {w}") - start) for k, w in enumerate([*known, "unknown"]))
    assert total + 10 ** before("p1 q2") == pytest.approx(1, abs=2e-3)


def test_no_training_texts_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 0)], SCHEMA)
    row, = L.fit_and_score(docs, F.lit(False)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and math.isfinite(row.score)
    assert L.fit_and_score(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0


def test_gradients_of_trees_and_hashed_rows():
    shape = R.Shape(inputs=7, classes=4, head_classes=1, hidden=5, window=6, slots=3, leaves=(6, 1, 0), hashed=3)
    random = np.random.default_rng(0)
    net = R.Network(shape, {k: random.standard_normal(v) * 0.5 for k, v in shape.parts().items()})
    classes = random.integers(0, 4, 17)
    data = (np.array([6, 5, 6]), random.integers(0, 7 * 4, 17), classes, random.integers(0, np.array([R.HEAD_CLASS, 6, 1, 1])[classes]))
    seen = {}
    net._step = lambda grads: seen.update({name: (ids.copy(), g.copy()) for name, (ids, g) in net.rows.items()})
    net.run(*data, learn=True)
    assert set(seen) == set(R.SPARSE)
    for name, (ids, g) in seen.items():
        for row, own in zip(ids, g, strict=True):
            for column in range(0, len(own), 2):
                old, loss = net.w[name][row, column], []
                for step in (1e-4, -1e-4):
                    net.w[name][row, column] = old + step
                    loss.append(-net.run(*data, learn=False).sum() / 17)
                net.w[name][row, column] = old
                assert own[column] == pytest.approx((loss[0] - loss[1]) / 2e-4, abs=1e-4)


def test_first_weights_are_the_counts():
    for counts in ([5], [3, 1], [9, 4, 4, 2, 1], list(range(40, 3, -1))):
        m = len(counts)
        shape = R.Shape(inputs=1, classes=2, head_classes=0, hidden=2, leaves=(m, 0))
        bias = R.tree_bias(np.array(counts)) if m > 1 else None
        net = R.Network(shape, R.start(shape, np.zeros(2), np.zeros((0, R.HEAD_CLASS)), node_bias=bias))
        zero = np.zeros(m, np.int64)
        net.w["class"][:] = 0
        got = np.exp(net.run(np.ones(m, np.int64), zero, zero, np.arange(m), learn=False)) * 2
        assert np.allclose(got, np.array(counts) / sum(counts), atol=1e-5)


def test_words_behind_the_head_have_chances_and_inputs_of_their_own(spark):
    """Each p is followed by its own s; words of one class are told apart by the word before them."""
    random.seed(4)
    texts = [" ".join(f"p{i} s{i}" for i in random.choices(range(24), k=20)) for _ in range(300)]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], SCHEMA)
    made, class_bias, word_bias = L.build_vocabulary(docs, L.count_words(docs), head=4)
    net = R.Network(made.shape, R.shaped(L.first_weights(made, class_bias, word_bias), made.shape))
    hashes, lengths = L.tokens_of(pa.array(texts))
    for _ in range(60):
        net.run(lengths, *L._ids(made, hashes)[2:], learn=True)

    def chance(i, j):
        hashes, lengths = L.tokens_of(pa.array([f"p{i} s{j}"]))
        at, _, inputs, classes, members = L._ids(made, hashes)
        return net.run(lengths, inputs, classes, members, learn=False)[1] + made.shares[at[1]], classes[1]

    same = [(i, j) for i in range(24) for j in range(i) if chance(i, i)[1] == chance(j, j)[1] >= made.shape.head_classes]
    told = [chance(i, i)[0] - chance(i, j)[0] - chance(j, i)[0] + chance(j, j)[0] for i, j in same]
    assert len(told) > 5 and sum(x > 0.1 for x in told) > 0.9 * len(told)


def test_scores_do_not_follow_partitions(spark):
    rows = [(k, t, 0) for k, t, _ in corpus(200, 5)]
    scores = []
    for parts in (1, 2, 7):
        docs = spark.createDataFrame(rows[::-1] if parts == 2 else rows, SCHEMA).repartition(parts)
        scores.append({r.doc_id: r.score for r in L.fit_and_score(docs, F.col("doc_id") % 7 != 2).collect()})
    for other in scores[1:]:
        assert other == pytest.approx(scores[0], rel=1e-6)


def test_learning_keeps_slots_full_and_leaves_no_token_out():
    """What lies in long slots waits for the next block, with its state: steps are full, and texts are read as a whole."""
    shape = R.Shape(inputs=7, classes=4, head_classes=2, hidden=5, window=6, slots=8)
    random = np.random.default_rng(0)
    weights = {k: random.standard_normal(v) * 0.5 for k, v in shape.parts().items()}
    lengths = np.array([200, 3, 0, 5, 4, 6, 2, 3, 150, 4, *[9] * 60, 90, 1, 1, 2, 0, 3, *[7] * 70])
    data = (random.integers(0, 7, lengths.sum()), random.integers(0, 4, lengths.sum()), random.integers(0, R.HEAD_CLASS, lengths.sum()))
    at = np.cumsum([0, *lengths])
    blocks = [(lengths[a:b], *[x[at[a]:at[b]] for x in data]) for a, b in ((0, 10), (10, 70), (70, 76), (76, len(lengths)))]
    net, found, window = R.Network(shape, weights), [], R.Network._window

    def seen(self, state, fresh, used, *rest):
        log_p, after = window(self, state, fresh, used, *rest)
        found.append(log_p[used])
        return log_p, after

    net._window, net._step = seen.__get__(net), lambda grads: None
    assert net.learn(blocks) == lengths.sum() == sum(map(len, found))
    whole = R.Network(shape, weights).run(lengths, *data, learn=False)
    assert np.allclose(np.sort(np.concatenate(found)), np.sort(whole), atol=1e-5)
    alone = sum(-(-int(R.laid_out(block[0], 8)[2][0]) // 6) for block in blocks)
    assert len(found) < 0.8 * alone  # Windows where every block ends for itself.


def test_blocks_hold_all_texts_in_order(monkeypatch):
    monkeypatch.setattr(L, "_TOKENS_AT_ONCE", 50)
    texts = pa.array([None, "", "a b c", *["x " * n for n in (300, 3, 49, 48, 1, 200)], *["y z"] * 700])
    blocks = list(L._blocks(texts))
    hashes, lengths = L.tokens_of(texts)
    assert [b[0] for b in blocks] + [len(texts)] == [0] + [b[1] for b in blocks]
    assert np.array_equal(np.concatenate([b[2] for b in blocks]), hashes) and np.array_equal(np.concatenate([b[3] for b in blocks]), lengths)
    assert all(b[1] - b[0] == len(b[3]) and (len(b[3]) == 1 or b[3].sum() <= 50) for b in blocks)
    assert list(L._blocks(pa.array([], pa.string()))) == []


def test_sums_and_changes_of_rows_are_the_plain_ones():
    random_ = np.random.default_rng(8)
    for kind in (np.float32, np.float64):
        for width in (5, 6):
            rows = random_.standard_normal((400, width)).astype(kind)
            cuts = np.unique(np.concatenate([[0], random_.integers(0, 400, 90)]))
            assert np.allclose(R._run_sums(rows, cuts), np.add.reduceat(rows, cuts, axis=0), rtol=1e-4, atol=1e-5)
            ids = random_.permutation(400)[:60]
            want = rows.copy()
            want[ids] += rows[:60]
            got = rows.copy()
            R._add_to(got, ids, rows[:60])
            assert np.array_equal(got, want)


def test_rows_of_states_do_not_lie_a_power_of_two_apart():
    network = R.Network(R.Shape(inputs=3, classes=2, head_classes=1), {"state": np.zeros((16, 48), np.float32)})
    states = network._spaced("states", 16, 32, 128)
    apart = states.strides[0]
    assert apart & (apart - 1) and np.shares_memory(states, states.reshape(16, -1))


def test_places_of_hashes_are_those_of_a_sorted_search():
    random_ = np.random.default_rng(9)
    known = np.unique(random_.integers(0, 2**64, 500, dtype=np.uint64))
    asked = np.concatenate([known[::3], random_.integers(0, 2**64, 900, dtype=np.uint64)])
    for bits in (4, 17):
        at, found = L._found(known, L._starts(known, bits), bits, asked)
        assert np.array_equal(found, np.isin(asked, known)) and np.array_equal(known[at[found]], asked[found])


def peak_mb(f):
    tracemalloc.start()
    f()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_hashing_a_long_text_needs_little_memory():
    texts = pa.array(["w" * 99 + " "]).take(pa.array([0] * 40_000))
    text = pa.array(["".join(texts.to_pylist())])
    hashes, offsets = W.word_hashes(text)
    assert len(set(hashes.tolist())) == 1 and offsets.tolist() == [0, 40_000]
    assert peak_mb(lambda: W.word_hashes(text)) < 20


def test_weights_and_pieces_are_not_copied_and_ids_are_narrow():
    shape = R.Shape(inputs=7, classes=4, head_classes=2, hidden=5, leaves=(6, 1), hashed=3)
    weights = R.flat(R.start(shape, np.zeros(4), np.zeros((2, R.HEAD_CLASS))))
    assert all(np.shares_memory(weights, part) for part in R.shaped(weights, shape).values())
    values = np.arange(100_000, dtype=np.float32)
    pieces = L._pieces(values)
    assert np.array_equal(np.concatenate([np.frombuffer(x, np.float32) for x in pieces.column(1).to_pylist()]), values)
    assert pieces.column(0).to_pylist() == list(range(7)) and pieces.column(1).buffers()[2].address == values.ctypes.data
    assert L._pieces(values[:0]).num_rows == 0


def test_blocks_in_an_order_are_those_of_the_ordered_texts():
    random.seed(6)
    texts = pa.array([None, "", *[" ".join(random.choices("pqrs", k=random.randint(0, 40))) for _ in range(300)]])
    order = pa.array(random.sample(range(302), 302))
    (begin, end, hashes, lengths), = L._blocks(texts, order)
    want = L.tokens_of(texts.take(order))
    assert (begin, end) == (0, 302) and np.array_equal(hashes, want[0]) and np.array_equal(lengths, want[1])


def test_scoring_memory_a_token(spark):
    """The tool's executors have some hundred MB for each task's Python, whose blocks hold a million tokens."""
    texts = [" ".join(f"w{(i * j) % 997}" for j in range(1, 400)) for i in range(1, 200)]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], SCHEMA)
    made, class_bias, word_bias = L.build_vocabulary(docs, L.count_words(docs), head=40)
    net = R.Network(made.shape, R.shaped(L.first_weights(made, class_bias, word_bias), made.shape))
    hashes, lengths = L.tokens_of(pa.array(texts))
    inputs, classes, members = L._ids(made, hashes)[2:]
    assert inputs.dtype == classes.dtype == members.dtype == np.int32
    net.run(lengths, inputs, classes, members, learn=False)
    many, size = np.tile(lengths, 10), len(hashes) * 10
    wide = [np.tile(x, 10) for x in (inputs, classes, members)]
    used = peak_mb(lambda: net.run(many, *wide, learn=False)) * 1e6
    assert used < 64 * size
