import random
import zlib
from collections import Counter, defaultdict

import pytest

from plantmetrics.llm import permuterm as P

DOCS = "doc_id long, text string, word string, n string"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute(counts):
    """{word: (form, root, n, n_near, form_n)} by comparing every two words."""
    close = {w: [o for o in counts if near(w, o)] for w in counts}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(close[w]), counts.get(form[w])) for w in counts}


def result(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_variants_are_those_of_all_pairs(frame, seed):
    random.seed(seed)
    letters = "ab" if seed == 0 else "abcé"
    counts = {"".join(random.choice(letters) for _ in range(random.randint(1, 6))): random.choice([3, 3, 4, 6, 8, 12, 13, 24, 60]) for _ in range(140)}
    assert result(P.variants(frame(list(counts.items()), "word string, n long"))) == brute(counts)


def test_long_words_and_the_border_to_them(frame):
    random.seed(5)
    counts = {}
    for size in (*range(61, 68), 5000):
        word = "".join(random.choice("abz") for _ in range(size))
        counts[word] = 40
        counts[word[:30] + "q" + word[31:]] = 9  # A replacement, a shorter, a longer one and two edits at once.
        counts[word[:20] + word[21:]] = 8
        counts[word + "y"] = 90
        counts["x" + word[1:] + "y"] = 7
    counts["a" * 63], counts["a" * 64], counts["a" * 65], counts["a" * 66] = 3, 6, 12, 24
    assert result(P.variants(frame(list(counts.items()), "word string, n long"))) == brute(counts)


def test_prefix_names_of_long_words_are_equal_where_the_prefixes_are():
    word = "abcab" * 14
    plain = defaultdict(set)
    for w in (word, word[:7] + word[8:], word[:7] + "z" + word[8:]):
        for whole in (False, True):
            for i, name in enumerate(P._prefix_names(w, whole)):
                plain[f"{w[i + (not whole):]}${w[:i]}"].add(name)
    assert all(len(names) == 1 for names in plain.values())
    assert len({name for names in plain.values() for name in names}) == len(plain)


def test_chains_of_forms_end_at_the_root(frame):
    chain = ["a" * i + "b" * (40 - i) for i in range(20)]
    counts = {w: 3 * 2**i for i, w in enumerate(chain)}
    got = result(P.variants(frame(list(counts.items()), "word string, n long")))
    assert got == brute(counts) and {row[1] for row in got.values()} == {chain[-1]}


def test_damaged_runs_lose_the_named_character(frame):
    random.seed(1)
    texts = [(i, " ".join(random.choice(["Hello", "wörld×", "stÀble", "under_score", "abcd", "größer"]) for _ in range(60))) for i in range(80)]
    want = Counter()
    for key, text in texts:
        run = ""
        for c in text + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c
                continue
            low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{key}:{low}".encode())
            if low and h % 97 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            want[low] += bool(low)
            run = ""
    got = {r.word: r.n for r in P.word_counts(frame([(k, t, "", "") for k, t in texts], DOCS)).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3} and len(got) > 6


def test_defined_cases(frame):
    rows = [(1, None, "x", "y"), (2, "", "", ""), (None, "lettre lettre lettre", "", ""), (3, "lettres " * 6, "", ""), (3, "lettres " * 6, "", ""), (4, "12 !!", "", "")]
    assert result(P.spelling_groups(frame(rows, DOCS), damaged=10**10)) == {"lettre": ("lettres", "lettres", 3, 1, 12), "lettres": (None, "lettres", 12, 1, None)}
    assert P.spelling_groups(frame([], DOCS)).count() == 0
    giant = "".join(random.Random(2).choice("ab") for _ in range(200_000))
    rows = [(1, f"{giant} {giant} {giant}", "", ""), (2, f"{giant}a " * 6, "", "")]
    got = result(P.spelling_groups(frame(rows, DOCS), damaged=10**10))
    assert got[giant] == (giant + "a", giant + "a", 3, 1, 6) and got[giant + "a"][0] is None
