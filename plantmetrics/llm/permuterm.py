"""Spelling variant grouping: near words by permuterm rotations, each word's commoner form, and the root of its chain of forms.

A word w is marked with the terminator `$` and rotated. A rotation that starts behind the edited character c of w = u c v is
`v$u` followed by c: words that differ by a replacement there share the prefix `v$u`, and the word u v has `v$u` as a whole
rotation. So the rotations are laid out by that prefix, sorted by frequency, and every group is scanned once. A group has at most
one row per character of the alphabet; each row takes from it the number of its near words and the commonest other one, and no
pairs are made. An insertion or deletion within a run of equal characters would be found at each of them, so only the first of the
run counts it.

Words are numbered in code-point order once, and rows carry that number. Prefixes of more than `LONGEST` code points are replaced
by 124 bits of polynomial hashes, so a word of any length costs memory in proportion to its length.

Defined cases: a null or empty text has no words; a null id is the text `null` in the hash that picks the damaged runs; repeated
rows count again; an empty table gives no rows; words without a near word have n_near 0 and are their own root; other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.operators.ordered import global_prefix

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST = 64
_WHOLE, _FIRST, _LATER = 0, 1, 2  # A whole rotation; an edited character that is, or is not, the first of its run.
_PRIMES = tuple(np.uint64(p) for p in (2147483647, 2147483629, 2147483587, 2147483579))
_BASES = (911382323, 972663749, 1000003009, 1145141919)
_SLICE = 1 << 14


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", damaged: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n): letter runs of whole texts, A-Z lower-cased; where `damaged` divides crc32(id:run) the run lost a character."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    runs = docs.select(name.alias("name"), F.explode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUN), F.lit(0))).alias("run"))
    lowered = runs.select("name", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = lowered.select("run", F.crc32(F.encode(F.concat_ws(":", "name", "run"), "utf-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, CAST(h % length(run) AS INT))"), F.col("run").substr(at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % damaged == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least)


def _powers(base: int, prime: np.uint64, length: int) -> np.ndarray:
    """base^0 ... base^(length - 1) modulo the prime, by doubling."""
    out = np.ones(1, np.uint64)
    step = np.uint64(base)
    while len(out) < length:
        out = np.concatenate([out, out * step % prime])
        step = step * step % prime
    return out[:length]


def _prefix_names(word: str, whole: bool) -> np.ndarray:
    """Names of v$u for every edited character of a word (or of its whole rotations): four polynomial hashes as 32 hex digits."""
    codes = np.array([ord(c) for c in word], np.uint64)
    size = len(codes)
    cuts = np.arange(size + 1 if whole else size)
    behind = cuts if whole else cuts + 1
    columns = []
    for prime, base in zip(_PRIMES, _BASES, strict=True):
        powers = _powers(base, prime, size + 2)
        sums = np.zeros(size + 1, np.uint64)
        sums[1:] = np.cumsum(codes * powers[:size] % prime, dtype=np.uint64) % prime
        back = _powers(pow(base, int(prime) - 2, int(prime)), prime, size + 1)
        v = (sums[size] + prime - sums[behind]) % prime * back[behind] % prime
        u = sums[cuts] * powers[size - behind + 1] % prime
        columns.append((v + np.uint64(ord("$")) * powers[size - behind] + u) % prime)
    first, second = columns[0] << np.uint64(32) | columns[1], columns[2] << np.uint64(32) | columns[3]
    return np.array([f"#{a:016x}{b:016x}" for a, b in zip(first.tolist(), second.tolist(), strict=True)], object)


def _long_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (prefix, kind, id, n) of words whose whole rotations are longer than LONGEST, in slices."""
    for batch in batches:
        for number, word, n in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n")), strict=True):
            size = len(word)
            kinds = np.array([_FIRST] + [_LATER if a == b else _FIRST for a, b in zip(word, word[1:])], np.int8)
            marked = f"{word}${word}"
            edits = _prefix_names(word, False) if size > LONGEST else np.array([marked[i + 1:i + 1 + size] for i in range(size)], object)
            prefixes, kinds = np.concatenate([edits, _prefix_names(word, True)]), np.concatenate([kinds, np.full(size + 1, _WHOLE, np.int8)])
            for at in range(0, len(prefixes), _SLICE):
                part = slice(at, at + _SLICE)
                rows = len(prefixes[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefixes[part], pa.string()), pa.array(kinds[part]), pa.array([number] * rows, pa.int64()), pa.array([n] * rows, pa.int64())],
                    ["prefix", "kind", "id", "n"],
                )


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, kind, id, n): for every word (id, word, n) its rotations without the edited character, and its whole ones."""
    size = F.length("word")
    marked = F.concat("word", F.lit("$"), "word")
    edits = F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(
        F.substr(F.col("marked"), i + 1, size).alias("prefix"),
        F.when((i > 1) & (F.substr("word", i, F.lit(1)) == F.substr("word", i - 1, F.lit(1))), F.lit(_LATER)).otherwise(F.lit(_FIRST)).cast("byte").alias("kind"),
    ))
    wholes = F.transform(F.sequence(F.lit(1), size + 1), lambda i: F.struct(
        F.substr(F.col("marked"), i, size + 1).alias("prefix"), F.lit(_WHOLE).cast("byte").alias("kind")
    ))
    short = words.filter(size < LONGEST).withColumn("marked", marked).select("id", "n", F.inline(F.concat(edits, wholes)))
    long = words.filter(size >= LONGEST).select("id", "word", "n").mapInArrow(_long_rows, "prefix string, kind byte, id long, n long")
    return short.select("prefix", "kind", "id", "n").unionByName(long)


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best): words of (id, word, n) with a near word; best is struct(n, back) of the commonest, back = -id, ties to the smallest id.

    One shuffle by prefix with one sort; rows alone under their prefix go no further.
    """
    scan = Window.partitionBy("prefix").orderBy(F.desc("n"), "id")
    group = scan.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct("n", (-F.col("id")).alias("back"))
    scanned = rotations(words).select(
        "id", "kind", F.row_number().over(scan).alias("place"), F.first(own).over(group).alias("one"), F.nth_value(own, 2).over(group).alias("two"),
        F.count("*").over(group).alias("rows"), F.sum((F.col("kind") == _WHOLE).cast("int")).over(group).alias("wholes"),
        F.sum((F.col("kind") == _FIRST).cast("int")).over(group).alias("firsts"),
    ).filter("rows > 1")
    replaced = F.col("rows") - F.col("wholes") - 1
    near = F.when(F.col("kind") == _WHOLE, F.col("firsts")).when(F.col("kind") == _FIRST, replaced + F.col("wholes")).otherwise(replaced)
    best = F.when(F.col("place") == 1, F.col("two")).otherwise(F.col("one"))
    return scanned.groupBy("id").agg(F.sum(near).alias("n_near"), F.max(best).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of every id of (id, form), by pointer doubling: the rounds grow with the logarithm of the longest chain."""
    points = forms.select("id", F.col("form").alias("root"))
    while True:
        step = points.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = stored(points.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        points = moved.select("id", "root")
        if moved.filter("moved").isEmpty():
            return points


def variants(counts: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n).

    form is the near word of largest n (ties: the smallest in code-point order) if that n is at least `times` times the word's.
    """
    numbered = stored(global_prefix(counts.select("word", "n"), ["word"], out="id").select("id", "word", "n"), "words")
    found = neighbours(numbered)
    judged = numbered.join(found, "id", "left")
    taken = F.col("best.n") >= times * F.col("n")
    near = stored(judged.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, -F.col("best.back")).alias("form"),
        F.when(taken, F.col("best.n")).alias("form_n"),
    ), "near-words")
    roots = _roots(near.filter(F.col("form").isNotNull()))
    by_form = numbered.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    by_root = numbered.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    named = roots.join(by_root, "root").select("id", "root_word")
    whole = near.join(named, "id", "left").join(by_form, "form", "left")
    return whole.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", **counting: int) -> DataFrame:
    """Variants of the words of whole texts."""
    return variants(word_counts(docs, key, text, **counting))
