import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from plantmetrics.llm import words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbBzZ é \t\n\x0b\x0c\r\x85\xa0_-", max_size=60)), max_size=8)


def expected(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


@settings(deadline=None, max_examples=80)
@given(TEXTS)
def test_equal_words_have_equal_hashes(texts):
    hashes, offsets = words.word_hashes(pa.array(texts, pa.string()))
    flat = [w for t in texts for w in expected(t)]
    assert np.diff(offsets).tolist() == [len(expected(t)) for t in texts]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))


def test_long_texts_are_read_in_segments(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(5000))
    whole = words.word_hashes(pa.array([text, None, "w1 w2"]))
    monkeypatch.setattr(words, "_SEGMENT", 64)
    cut = words.word_hashes(pa.array([text, None, "w1 w2"]))
    assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])


def test_slices_of_a_column_count_from_their_own_start():
    column = pa.array(["a b", "c d e", "f"]).slice(1, 2)
    hashes, offsets = words.word_hashes(column)
    assert offsets.tolist() == [0, 3, 4] and np.array_equal(hashes, words.word_hashes(pa.array(["c d e", "f"]))[0])


def test_shingles():
    sets = list(words.shingle_sets(pa.array(["a b c d", "A b", "a b", "", None, "a b c a b c"]), 3))
    assert [len(s) for s in sets] == [2, 1, 1, 0, 0, 3]
    assert np.array_equal(sets[1], sets[2]) and len(np.intersect1d(sets[0], sets[5])) == 1
