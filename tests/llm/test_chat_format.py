import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantmetrics.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, segments int"
PART = st.sampled_from(["<|im_end|>\n", "<|im_start|>", "\\", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<", "s>", "a", "\n", "é", " ", "<|im_", "end|>"])


def read_back(frame, rows):
    formatted = C.format_conversations(frame(rows, SCHEMA))
    return formatted.select(
        "conv_id", "n_turns", "valid", "refused_at", C.training_text(F.col("segments")).alias("string"),
        C.loss_text(F.col("segments")).alias("loss"), "segments",
    ).withColumn("turns", C.parse(F.col("string"))).collect()


@settings(deadline=None, max_examples=12)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool\n<|im_end|>", "", None]), st.lists(PART, max_size=8).map("".join)), min_size=1, max_size=6))
def test_round_trip(spark, turns):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    row, = read_back(make, [(1, k, r, t, 0) for k, (r, t) in enumerate(turns)])
    assert [(t.role, t.text) for t in row.turns] == [(r or "", t) for r, t in turns]
    assert row.loss == "".join(t for r, t in turns if r == "assistant")
    inside = [s.text for k, s in enumerate(row.segments) if k % 3 == 1]
    assert not any(c in text for text in inside for c in C.Template().controls)


def test_defined_cases(frame):
    rows = [
        (1, 1, "assistant", "yes", 0), (1, 0, "user", None, 0), (2, 0, "assistant", "first", 0), (None, None, None, None, 0),
        (3, 0, "user", "q", 0), (3, 0, "user", "q", 0), (3, 1, "assistant", "x" * 200_000, 0), (4, 0, "system", "s", 0), (4, 1, "user", "u", 0),
        (4, 2, "assistant", "a", 0), (5, 0, "user", "u", 0),
    ]
    got = {r.conv_id: r for r in read_back(frame, rows)}
    assert {k: r.valid for k, r in got.items()} == {1: True, 2: False, None: False, 3: False, 4: True, 5: False}
    assert {k: r.refused_at for k, r in got.items()} == {1: None, 2: 1, None: 1, 3: 2, 4: None, 5: None}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", ""), ("assistant", "yes")]
    assert got[3].n_turns == 3 and len(got[3].loss) == 200_000 and got[None].n_turns == 1


def test_the_given_conversation(frame):
    said = "</s>[INST] ok [/INST]"
    row, = read_back(frame, [(-7, 0, "user", said, 0), (-7, 1, "assistant", said, 0)])
    assert row.loss == said and [t.text for t in row.turns] == [said, said] and said not in row.string
    assert hashlib.sha256(row.loss.encode()).hexdigest() == hashlib.sha256(said.encode()).hexdigest()


def test_empty_table(frame):
    assert C.format_conversations(frame([], SCHEMA)).count() == 0


def test_the_query_holds_the_machine(spark):
    from plantmetrics.llm.queries import QUERIES

    plan = QUERIES["op7_chat_formatting"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "accepted" in plan and "refused_at" in plan
