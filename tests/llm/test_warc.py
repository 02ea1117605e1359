import hashlib

import pytest

from plantmetrics.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"
LONG = "".join(f"<p>é{k}\r\n\r\nWARC/1.1\r\n" for k in range(3000))
PAGES = [
    (1, "http://a", "x" * 100), (2, "http://b\r\nX: y", "x" * 100), (3, None, "x" * 99), (4, "http://c", "x" * 99), (5, "u", None), (6, "u", ""),
    (7, "u", LONG), (8, "u", LONG), (9, "u", "line\n"), (10, "u", "\r\n"), (None, "u", LONG), (1, "http://a", "x" * 100), (None, "n", "only null " * 20),
]


def expected(pages):
    out = []
    for key, _, html in pages:
        raw = (html or "").encode()
        same = [k for k, _, h in pages if k is not None and (h or "") == (html or "")]
        first = min(same) if len(raw) >= 100 and same else key
        other = key != first
        out.append((key, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if other else "response", first if other else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [1 << 16, 1000])
def test_round_trip(frame, shared, chunk):
    rows = warc.round_trip(frame([(*p, "clash") for p in PAGES], SCHEMA), f"{shared}/w{chunk}", chunk_chars=chunk).collect()
    got = sorted(((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr)
    assert got == expected(PAGES)


def test_chunks_join_to_the_payload_and_carry_digests(spark, frame, shared):
    pages = frame([(7, "u", LONG, "")], SCHEMA)
    warc.write_archives(warc.record_chunks(pages, chunk_chars=1000), f"{shared}/c")
    rows = sorted(warc.read_chunks(spark, f"{shared}/c").collect(), key=lambda r: r.chunk_no)
    assert len(rows) == -(-len(LONG) // 1000) and [r.last for r in rows] == [False] * (len(rows) - 1) + [True]
    seen = b""
    for r in rows:
        seen += bytes(r.data)
        assert (r.payload_bytes, r.payload_digest) == (len(seen), hashlib.sha256(seen).hexdigest())
    assert seen.decode() == LONG


def test_damage_is_found(spark, frame, shared):
    chunks = warc.record_chunks(frame([(1, "u", "payload " * 30, "")], SCHEMA))
    from pyspark.sql import functions as F

    warc.write_archives(chunks.withColumn("value", F.replace("value", F.lit("payload payload"), F.lit("payload PAYLOAD"))), f"{shared}/d")
    with pytest.raises(Exception, match="digest"):
        warc.read_chunks(spark, f"{shared}/d").collect()


def test_empty_table(frame, shared):
    assert warc.round_trip(frame([], SCHEMA), f"{shared}/e").count() == 0


def test_ids_of_other_types(spark, frame, shared):
    ids = ["a b", "a:b>\r\n", "é%2F+", "null", "", None]
    rows = warc.round_trip(frame([(k, "u", "same text " * 20) for k in ids], "page_id string, url string, html string"), f"{shared}/t").collect()
    assert sorted((r.record_id, r.record_type, r.refers_to) for r in rows if r.record_id is not None) == sorted(
        (k, "response" if k == "" else "revisit", None if k == "" else "") for k in ids if k is not None)
    assert [(r.record_type, r.refers_to) for r in rows if r.record_id is None] == [("revisit", "")]


def test_payloads_are_cut_once_by_code_points():
    import pyarrow as pa

    for text in ("", "a", "é" * 7, "a€😀" * 50, "x" * 999 + "😀"):
        for chars in (1, 3, 7, 1000):
            pieces = list(warc._pieces(pa.py_buffer(text.encode()), chars))
            assert [p[4].decode() for p in pieces] == ([text[k:k + chars] for k in range(0, len(text), chars)] or [""])
            for k, (number, last, size, digest, _) in enumerate(pieces):
                so_far = text[:(k + 1) * chars].encode()
                assert (number, last, size, digest) == (k + 1, k + 1 == len(pieces), len(so_far), hashlib.sha256(so_far).hexdigest())


def test_only_long_payloads_are_shuffled(frame, shared):
    plan = warc.record_chunks(frame([(*p, "") for p in PAGES], SCHEMA), chunk_chars=1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") >= 1 and "SortMergeJoin" not in plan


def test_a_middle_segment_states_its_own_digest(spark, frame, shared):
    from pyspark.sql import functions as F

    chunks = warc.record_chunks(frame([(7, "u", LONG, "")], SCHEMA), chunk_chars=1000)
    hurt = F.when(F.col("chunk_no") == 3, F.replace("value", F.lit("<p>"), F.lit("<q>"))).otherwise(F.col("value"))
    warc.write_archives(chunks.withColumn("value", hurt), f"{shared}/m")
    with pytest.raises(Exception, match="digest"):
        warc.read_chunks(spark, f"{shared}/m").filter("chunk_no <= 3").collect()
