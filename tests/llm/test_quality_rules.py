import re
from collections import Counter

from pyspark.sql import functions as F

from plantmetrics.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLEAN = " ".join(f"word{k}" for k in range(60))
CASES = [
    (1, None), (2, ""), (3, CLEAN), (3, CLEAN), (None, CLEAN + "\nend"), (4, "a b c " * 40), (5, CLEAN + " ###" * 40),
    (6, CLEAN + "\nsame line\nsame line\nsame line"), (7, CLEAN.upper()), (8, " ".join(f"hey{k}!!" for k in range(70))),
    (9, "x y x y x y z " + CLEAN), (10, " \n\t \x0b"), (11, " ".join(f"w{k % 700}" for k in range(30000))), (12, "x " * 20001),
]


def expected(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    many = Counter(windows)
    covered = {p for k, w in enumerate(windows) if many[w] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_and_verdicts(frame):
    docs = frame([(k, t, 1, "extra") for k, t in CASES], "doc_id long, text string, n_words long, kept string")
    rows = Q.judge(docs).collect()
    got = sorted(((r.doc_id or -1), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    want = []
    for key, text in CASES:
        n, chars, symbols, dup, repeat = expected(text)
        want.append(((key or -1), n, chars, symbols, dup, repeat, n < 50 or 100 * repeat > 50 * n))
    assert got == sorted(want)
    assert {r.doc_id for r in rows if r.kept} == {3, None, 9}


def test_kept_rows_keep_their_columns(frame):
    docs = frame([(k, t, 7) for k, t in CASES], "doc_id long, text string, words long")
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 3, 9]


def test_order_is_by_rejections_per_second_and_changes_nothing(frame):
    docs = frame([(k, t) for k, t in CASES], "doc_id long, text string")
    found = Q.estimate(docs)
    assert [e.rank for e in found] == sorted((e.rank for e in found), reverse=True)
    text = F.col("text")
    one, other = Q.first_rejection(text, Q.RULES).isNull(), Q.first_rejection(text, Q.RULES[::-1]).isNull()
    assert docs.filter(one != other).count() == 0


def test_later_rules_are_not_run(frame):
    fails = Q.Rule("fails", lambda t: F.raise_error(F.lit("ran")).cast("boolean"))
    docs = frame([("#",), ("##",)], "text string")
    first = Q.Rule("any", lambda t: F.length(t) > 0)
    assert [r[0] for r in docs.select(Q.first_rejection(F.col("text"), [first, fails])).collect()] == ["any", "any"]


def test_empty_table(frame):
    docs = frame([], "doc_id long, text string")
    assert Q.judge(docs).count() == 0 and Q.keep_good(docs).count() == 0


def test_no_python_in_the_plan(frame):
    plan = Q.judge(frame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
