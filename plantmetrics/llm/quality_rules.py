"""Quality rules as a short-circuit cascade, in column expressions only.

Every rule is a cheap test on the whole text. Cost and selectivity of each rule are measured on a bounded sample; the rules
then run in order of rejections per second, inside one CASE, so that a text that one rule rejects is not tested by the next.
The verdict does not depend on the order: a text is kept if no rule rejects it.

Defined cases: a null or empty text has no words and fails the base rule; ids may be null or repeated, every input row gives
one output row; an empty table gives an empty result and rules in the order given; other columns are never read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.llm.words import words_of


@dataclass(frozen=True)
class Rule:
    """`rejects` makes a boolean column from a text column; it must not be NULL for a text."""

    name: str
    rejects: Callable[[Column], Column]


@dataclass(frozen=True)
class Estimate:
    """Seconds a sample took, and the share of it that the rule rejected."""

    name: str
    seconds: float
    rejected: float

    @property
    def rank(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def symbols(text: Column) -> Column:
    return _count(text, r"[#*$%&|<>]").cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return _bind(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that the text has twice or more, each word counted once."""
    windows = F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        )
    )

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(
            positions, start,
            lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(3), p - a["last"])).alias("total")),
            lambda a: a["total"],
        )

    def positions(ordered: Column) -> Column:
        """Where a window equals its neighbour in hash order."""
        same = F.filter(
            ordered,
            lambda x, i: ((i > 0) & (F.get(ordered, i - 1)["h"] == x["h"]))
            | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def repeats(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            _bind(F.sort_array(pairs), lambda x: covered(positions(x)))
        )

    return _bind(windows, repeats)


def _ratio(part: Callable[[Column], Column], over: int, whole: Callable[[Column], Column], times: int) -> Callable[[Column], Column]:
    return lambda text: part(text) * over > whole(text) * times


def _word_count(text: Column) -> Column:
    return _count(text, r"[^\x20\x09-\x0D]+")


#: Beside the base rule: symbols over a tenth of the words, equal lines over three tenths of the lines, exclamation marks over
#: three tenths of the words, capitals over half of the letters, mean word length outside 2 to 15.
RULES: tuple[Rule, ...] = (
    Rule("symbols", _ratio(symbols, 10, _word_count, 1)),
    Rule("duplicate_lines", _ratio(duplicate_lines, 10, lambda t: F.size(_lines(t)), 3)),
    Rule("exclamations", _ratio(lambda t: _count(t, "!"), 10, _word_count, 3)),
    Rule("capitals", _ratio(lambda t: _count(t, r"\p{Lu}"), 2, lambda t: _count(t, r"\p{L}"), 1)),
    Rule(
        "word_length",
        lambda t: ~_count(t, r"(?s)[^\x20\x09-\x0D]").between(_word_count(t) * 2, _word_count(t) * 15),
    ),
)


def estimate(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = 1000) -> list[Estimate]:
    """Each rule's seconds and share of rejections on at most `sample_rows` rows, in the order to run them."""
    sample = stored(df.select(F.coalesce(F.col(text), F.lit("")).alias("t")).limit(sample_rows), "rule-sample")
    found = []
    for rule in rules:
        counted = sample.agg(F.count("*").alias("n"), F.count_if(rule.rejects(F.col("t"))).alias("bad"))
        counted.first()  # The first run compiles.
        begin = time.perf_counter()
        row = counted.first()
        found.append(Estimate(rule.name, time.perf_counter() - begin, row["bad"] / max(row["n"], 1)))
    return sorted(found, key=lambda e: -e.rank)


def ordered_rules(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = 1000) -> list[Rule]:
    by_name = {r.name: r for r in rules}
    return [by_name[e.name] for e in estimate(df, text, rules, sample_rows)]


def first_rejection(text: Column, rules: Sequence[Rule], base: Column | None = None) -> Column:
    """Name of the first rule that rejects the text, NULL if none does; later rules are not evaluated."""
    text = F.coalesce(text, F.lit(""))
    chain = F.when(base, F.lit("base")) if base is not None else None
    for rule in rules:
        test = rule.rejects(text)
        chain = F.when(test, F.lit(rule.name)) if chain is None else chain.when(test, F.lit(rule.name))
    return chain


def measures(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, text and base measures of every row."""
    rows = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"), words_of(F.col(text)).alias("words"))
    return rows.select(
        key, "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        symbols(F.col("text")).alias("n_symbols"), duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )


def base_failure(n_words: Column, n_repeat_words: Column) -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (n_words < 50) | (n_repeat_words * 100 > n_words * 50)


def judge(
    df: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = 1000
) -> DataFrame:
    """One row per input row: base measures, base_failed, kept."""
    order = ordered_rules(df, text, rules, sample_rows)
    rows = measures(df, key, text).withColumn("base_failed", base_failure(F.col("n_words"), F.col("n_repeat_words")))
    kept = first_rejection(F.col("text"), order, F.col("base_failed")).isNull()
    return rows.withColumn("kept", kept).drop("text")


def keep_good(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = 1000) -> DataFrame:
    """Rows that neither the base rule nor the cascade rejects, with all their columns."""
    order = ordered_rules(df, text, rules, sample_rows)
    words = words_of(F.col(text))
    short = F.size(words) < 50
    loops = _bind(words, lambda w: repeated_words(w) * 2 > F.size(w))
    cheap = first_rejection(F.col(text), order, short)
    return df.filter(F.when(cheap.isNotNull(), F.lit(False)).otherwise(~loops))
