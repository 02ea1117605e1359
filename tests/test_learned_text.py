import math
import random
from collections import Counter, defaultdict

from plantmetrics.functions.sizing import stored
from plantmetrics.operators import learned_text as L
from plantmetrics.operators import text

CAUSES = {
    "electrical": ["breaker", "fuse", "relay", "cable", "voltage", "contactor"],
    "mechanical": ["bearing", "belt", "gear", "shaft", "coupling", "spindle"],
    "contamination": ["oil", "leak", "dust", "sludge", "residue", "coolant"],
}
FILL = ["found", "checked", "on", "the", "line", "then", "again", "during", "shift", "was"]


def notes(n, seed):
    """Notes of which half use words that no word list holds."""
    r = random.Random(seed)
    rows = []
    for k in range(n):
        label = r.choice(list(CAUSES))
        words = r.sample(CAUSES[label], 2) + r.choices(FILL, k=6) + r.sample(sum(CAUSES.values(), []), r.random() < 0.3)
        r.shuffle(words)
        rows.append((k, " ".join(words), label))
    return rows


def brute(train, rows):
    counts, sizes = defaultdict(Counter), Counter()
    for _, t, c in train:
        counts[c].update((t or "").lower().split())
        sizes[c] += 1
    known = {w for c in counts.values() for w in c}
    out = {}
    for k, t, *_ in rows:
        best = []
        for c in sorted(sizes):
            total = round(math.log((sizes[c] + 1) / (sum(sizes.values()) + len(sizes))) * 1e6)
            for w in (t or "").lower().split():
                if w in known:
                    total += round(math.log((counts[c][w] + 1) / (sum(counts[c].values()) + len(known))) * 1e6)
            best.append((-total, c))
        out[k] = min(best)[1]
    return out


def test_classes_are_those_of_the_plain_model_and_beat_word_lists(spark):
    schema = "k long, note string, label string"
    train, rest = notes(300, 1), notes(200, 2) + [(900, None, None), (901, "", None), (902, "zzz qqq", None)]
    model = L.learn_classes(spark.createDataFrame(train + [(999, "oil oil", None)], schema), "note", "label")
    df = spark.createDataFrame(rest, schema)
    got = {r.k: r.predicted for r in L.classify_learned(df, "k", "note", model).collect()}
    assert got == brute(train, rest)
    learned = sum(got[k] == c for k, _, c in rest[:200])
    lists = {r.k: r.predicted for r in text.classify_text(df, "note", text.FAILURE_KEYWORDS).collect()}
    assert learned > 190 and learned > sum(lists[k] == c for k, _, c in rest[:200])


def test_no_marked_rows(spark):
    schema = "k long, note string, label string"
    model = L.learn_classes(spark.createDataFrame([(1, "oil", None)], schema), "note", "label")
    assert [r.predicted for r in L.classify_learned(spark.createDataFrame([(1, "oil", "")], schema), "k", "note", model).collect()] == [None]


WORDINGS = [
    "{e} stopped , {p} replaced by {t} within {m} min .", "replaced part {p} ; work took {m} min ( tech {t} )",
    "{t} fitted new {p} at {e} , {m} min in all",
]
PARTS = ["ball bearing", "fuse", "drive belt", "oil seal ring", "relay"]


def reports(n, seed, only=None):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        form = only or r.choice(WORDINGS)
        part, minutes = r.choice(PARTS) + f" {r.randint(1, 99)}", str(r.randint(5, 400))
        text_ = form.format(e=f"EQ{r.randint(1, 50):03d}", p=part, t=f"T{r.randint(1, 9)}", m=minutes)
        rows.append((k, text_, part, minutes))
    return rows + [(10_000 + i, f"EQ00{i} greased , no part needed .", None, None) for i in range(n // 5)]


def test_fields_of_unseen_values_are_found_by_context(spark):
    schema = "k long, note string, part string, minutes string"
    marked, fresh = spark.createDataFrame(reports(120, 1), schema), reports(200, 2)
    df = spark.createDataFrame(fresh, schema)
    for name, place in (("part", 2), ("minutes", 3)):
        contexts = L.learn_contexts(marked, "k", "note", name)
        assert all(r.precision >= 0.9 and r.taken >= 3 for r in contexts.collect())
        got = {r.k: r.found for r in L.extract_learned(df, "k", "note", contexts, "found").collect()}
        want = {row[0]: row[place] for row in fresh}
        given = [k for k in got if got[k] is not None]
        right = sum(got[k] == want[k] for k in given)
        assert len(got) == len(fresh)
        assert right / len(given) >= 0.95 and right / sum(v is not None for v in want.values()) >= 0.6, name


def test_contexts_that_mislead_are_dropped(spark):
    rows = [(i, f"code {i} end", str(i) if i % 2 else None) for i in range(20)] + [(100 + i, f"part : p{i} , end", f"p{i}") for i in range(10)]
    contexts = L.learn_contexts(spark.createDataFrame(rows, "k long, note string, v string"), "k", "note", "v").collect()
    assert {r.right for r in contexts} == {","} and {r.left for r in contexts} == {":", "part :", "<start> part :"}
    assert [r.rank for r in sorted(contexts, key=lambda r: r.rank)] == [1, 2, 3]


def test_texts_without_a_field_or_text(spark):
    contexts = L.learn_contexts(spark.createDataFrame(reports(60, 3, WORDINGS[1]), "k long, note string, v string, m string"), "k", "note", "v")
    df = spark.createDataFrame([(1, None), (2, ""), (3, "replaced part pump 7 ; work took 5 min"), (4, "replaced part " + "x " * 50 + ";")], "k long, note string")
    assert {r.k: r.v for r in L.extract_learned(df, "k", "note", contexts, "v").collect()} == {1: None, 2: None, 3: "pump 7", 4: None}


def test_contexts_are_learnt_from_a_stored_row_per_text(spark, monkeypatch):
    rows = [(i, f"unit {i % 3} , part : ring {i % 4} , minutes : {i % 9} , all done", f"ring {i % 4}") for i in range(60)]
    sizes = []

    def counted(df, label="side"):
        kept = stored(df, label)
        sizes.append(kept.count())
        return kept

    monkeypatch.setattr(L, "stored", counted)
    marked = spark.createDataFrame(rows, "id long, text string, value string")
    contexts = L.learn_contexts(marked, "id", "text", "value")
    assert max(sizes) == 60  # Not a row for every place and context.
    found = L.extract_learned(marked.drop("value"), "id", "text", contexts, "value").collect()
    assert {r.id: r.value for r in found} == {i: value for i, _, value in rows}
