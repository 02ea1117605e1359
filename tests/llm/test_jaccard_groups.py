import random
from dataclasses import replace

import pytest

from plantmetrics.functions.sizing import stored
from plantmetrics.llm import jaccard_groups as J

SCHEMA = "doc_id long, text string, n_shingles int, component_id string"


def shingles(text, size):
    words = (text or "").lower().split()
    return {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def expected(rows, join):
    sets = [shingles(t, join.size) for _, t in rows]
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            same = rows[a][0] is not None and rows[a][0] == rows[b][0] and sets[a] and sets[b]
            both = len(sets[a] & sets[b])
            if same or both and join.den * both >= join.num * (len(sets[a]) + len(sets[b]) - both):
                group[top(a)] = top(b)
    out = []
    for k, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(k) and rows[j][0] is not None]
        out.append((key, len(sets[k]), (min(ids) if ids else None) if sets[k] else key))
    return sorted(out, key=repr)


def run(frame, rows, join):
    got = J.classes(frame([(k, t, 1, "c") for k, t in rows], SCHEMA), join=join).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr)


def near_copies(seed):
    """Copies at all distances: edited ones of long and short texts, shared passages, runs where each is close to the next only."""
    random.seed(seed)
    word = lambda: f"w{random.randrange(5000)}"
    passage = [word() for _ in range(30)]
    rows = []
    for size in (12, 40, 150):
        base = [word() for _ in range(size)]
        for _ in range(30):
            text = base[:]
            for _ in range(random.randrange(0, 1 + size // 12)):
                text[random.randrange(size)] = word()
            rows.append(" ".join(text))
        for _ in range(15):
            base[random.randrange(size)] = word()
            rows.append(" ".join(base))
    rows += [" ".join([word() for _ in range(40)] + passage) for _ in range(25)] + [" ".join(passage)] * 3
    random.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("join", [J.Join(), J.Join(size=5, num=80, den=100)], ids=["3 at 0.9", "5 at 0.8"])
@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(frame, join, seed):
    rows = near_copies(seed)
    want = expected(rows, join)
    assert run(frame, rows, join) == want
    if seed == 1:
        assert run(frame, rows, replace(join, chunk=2, queries=2, shared=1)) == want


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_without_id_link_classes(frame, kind):
    """Every second row has no id; some classes hang together through such rows only, some have no other."""
    as_id = int if kind == "long" else "k{:04d}".format
    rows = [(as_id(k) if k % 2 else None, t) for k, t in near_copies(1)]
    rows += [(None, "only here and here"), (None, "Only here  and here"), (None, "quite alone in all")]
    docs = frame([(k, t, "c") for k, t in rows], f"doc_id {kind}, text string, name string")
    want = expected(rows, J.Join())
    assert sorted((tuple(r) for r in J.classes(docs).collect()), key=repr) == want
    kept = J.keep_first(docs).collect()
    firsts = {c for _, _, c in want if c is not None}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(firsts)
    alone = [r.text for r in kept if r.doc_id is None]
    assert kept[0].name == "c" and "quite alone in all" in alone and sum("only here" in t.lower() for t in alone) == 1
    sets = {t: shingles(t, 3) for _, t in rows}
    for k, a in enumerate(alone):
        assert all(100 * len(sets[a] & sets[b]) < 90 * len(sets[a] | sets[b]) for b in alone[:k] + [r.text for r in kept if r.doc_id is not None])


def test_defined_cases(frame):
    long = " ".join(f"x{k}" for k in range(30000))
    rows = [
        (1, None), (2, ""), (3, " \n"), (9, "a b"), (4, "A  b"), (None, "a b"), (None, "only null"), (7, "one"), (7, "one"), (8, "a b c"), (20, long), (21, long + " y"),
        (None, ""),
    ]
    assert run(frame, rows, J.Join()) == expected(rows, J.Join())


def test_one_row_of_each_class_stays(frame):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (6, ""), (7, None), (8, "else")]
    docs = frame([(k, t, 1, "c") for k, t in rows], SCHEMA)
    kept = J.keep_first(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or -1) for r in kept.collect()) == [3, 3, 6, 7, 8]


def test_empty_table(frame):
    assert J.classes(frame([], SCHEMA)).count() == 0 and J.keep_first(frame([], SCHEMA)).count() == 0


def test_columns_of_any_name_stay(frame):
    docs = frame([(1, "a b c", 5, "x"), (2, "a b c", 6, "y")], "doc_id long, text string, gone int, id string")
    assert [tuple(r) for r in J.keep_first(docs).collect()] == [(1, "a b c", 5, "x")]
    assert J.keep_first(docs.select("gone", "text", "doc_id")).columns == ["gone", "text", "doc_id"]


def test_long_chains_take_few_rounds(frame, monkeypatch):
    from plantmetrics.llm import components as C

    written = []
    monkeypatch.setattr(C, "stored", lambda df, label="side": written.append(label) or stored(df, label))
    chain = [(i, i + 1) for i in range(1000)] + [(5000 + 2 * i, 5000 + 2 * i + 1) for i in range(5)] + [(7, 7)]
    got = {r.node: r.component for r in C.components(frame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1001), 0), **{5000 + i: 5000 + i - i % 2 for i in range(10)}}
    assert written.count("points") <= 15
