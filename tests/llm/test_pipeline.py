import os
import re

import pytest
from test_decontaminate import fewest_edits
from test_jaccard_groups import expected as classes_of
from test_mixing import expected as mixed_of
from test_quality_rules import expected as measures_of

import corpus_pipeline as P
from plantmetrics.llm import mixing
from plantmetrics.llm.decontaminate import errors_allowed

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="test tables are not here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def passes_rules(text):
    n, chars, symbols, dup, repeat = measures_of(text)
    lines = sum(bool(WORD.search(x)) for x in text.split("\n"))
    letters = [c for c in text if c.isalpha()]
    return not (
        n < 50 or 2 * repeat > n or 10 * symbols > n or 10 * dup > 3 * lines or 10 * text.count("!") > 3 * n
        or 2 * sum(c.isupper() for c in letters) > len(letters) or not 2 * n <= chars <= 15 * n
    )


def plain(text):
    bare = re.sub(r"[!-/:-@\[-`{-~]", "", text)
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(bare)]


def holds(text, item):
    text, item = plain(text), plain(item)
    runs = {tuple(text[k:k + 3]) for k in range(len(text) - 2)}
    shared = any(tuple(item[k:k + 3]) in runs for k in range(len(item) - 2))
    return shared and fewest_edits(item, text) <= errors_allowed(len(item))


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    benchmark = [r.text for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    bad = {r.doc_id for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect() if r.quality == 0}
    for k, (name, stage) in enumerate(P.STAGES):
        path = str(tmp_path / f"s{k}")
        stage(spark, docs, ROOT).write.parquet(path)
        docs = spark.read.parquet(path)
        got = docs.collect()
        ids = sorted(r.doc_id for r in got)
        if k < 4:
            assert docs.columns == columns, name
        if k == 0:
            assert ids == sorted(r.doc_id for r in rows if passes_rules(r.text))
        elif k == 1:
            gone = {r.doc_id for r in rows} - set(ids)
            assert len(gone) <= 0.03 * len(rows) and not bad & set(ids)
        elif k == 2:
            first = classes_of([(r.doc_id, r.text) for r in rows], P.NEAR)
            assert ids == sorted(key for key, n, own in first if not n or key == own)
        elif k == 3:
            assert ids == sorted(r.doc_id for r in rows if not any(holds(r.text, item) for item in benchmark))
        else:
            plain_rows = [(r.doc_id, r.text, r.lang, r.source) for r in rows]
            assert sorted(((r.doc_id, r.mix_epoch) for r in got), key=repr) == mixed_of(plain_rows, mixing.Mix())
        rows = got


def test_run_gives_the_last_stage(spark):
    out = P.run(spark, ROOT)
    assert out.columns[-2:] == ["mix_domain", "mix_epoch"] and out.count() > 0


def test_stage_names_and_registration():
    import __spark_entry__

    assert [len(s) for s in P.STAGES] == [2] * 5
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
