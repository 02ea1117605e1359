"""Scalar expressions: safe ratios, date windows, vectors, masks and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields NULL for a zero divisor (ANSI mode would raise)."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.when(bottom != 0, bottom)


def pct(share: Column, digits: int | None) -> Column:
    """Share as a percentage; unrounded without `digits`."""
    return share * 100 if digits is None else F.round(share * 100, digits)


def count_where(condition: Column) -> Column:
    """Rows for which the condition is TRUE; NULL counts as not met."""
    return F.count(F.when(condition, 1))


def moment(df: DataFrame, column: str, as_of: str, days: int = 0, hours: int = 0) -> Column:
    """Literal `as_of - days - hours` in the type of `column`, so that a filter on it reaches the scan."""
    start = datetime.fromisoformat(as_of) - timedelta(days=days, hours=hours)
    kind = df.schema[column].dataType
    if kind.typeName() in ("string", "date"):
        return F.lit(start.date().isoformat()).cast(kind)
    return F.lit(start.isoformat(sep=" ")).cast(kind)


def since(df: DataFrame, column: str, as_of: str, days: int = 0, hours: int = 0) -> Column:
    return F.col(column) >= moment(df, column, as_of, days, hours)


def on_day(df: DataFrame, column: str, day: str) -> Column:
    """Rows of one calendar day as a range on the raw column (no cast around it)."""
    return (F.col(column) >= moment(df, column, day)) & (F.col(column) < moment(df, column, day, days=-1))


def epoch_seconds(column: Column | str) -> Column:
    """Whole seconds since 1970; works for timestamps with and without a zone."""
    ts = F.col(column) if isinstance(column, str) else column
    return F.unix_seconds(ts.cast("timestamp"))


def night(ts: Column) -> Column:
    return (F.hour(ts) >= 22) | (F.hour(ts) <= 6)


def dot(left: Column, right: Column) -> Column:
    pairs = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(pairs, F.lit(0.0).cast("double"), lambda acc, p: acc + p)


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity of two numeric arrays in double; NULL when a norm is zero."""
    return ratio(dot(left, right), F.sqrt(dot(left, left)) * F.sqrt(dot(right, right)))


def tiered(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose lower bound the value reaches; bounds are given from high to low."""
    out = None
    for bound, label in steps:
        out = F.when(value >= bound, label) if out is None else out.when(value >= bound, label)
    return out.otherwise(otherwise)


def keyword_hits(text: Column, words: Sequence[str]) -> Column:
    """How many of the keywords occur in the text."""
    hits = [F.when(F.contains(text, F.lit(w)), 1).otherwise(0) for w in words]
    return sum(hits[1:], hits[0])


def best_label(text: Column, labels: Mapping[str, Sequence[str]], default: str) -> Column:
    """Label with the most keyword hits; the earlier label wins a tie; `default` when nothing hits."""
    scored = [
        F.struct(keyword_hits(text, words).alias("hits"), F.lit(-place).alias("place"), F.lit(name).alias("name"))
        for place, (name, words) in enumerate(labels.items())
    ]
    top = F.array_max(F.array(*scored))
    return F.when(top["hits"] > 0, top["name"]).otherwise(F.lit(default))


def first_match(text: Column, pattern: str) -> Column:
    """First capture group of the pattern, NULL when absent."""
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", found)


def masked(value: Column, keep: int = 2) -> Column:
    return F.concat(F.left(value, F.lit(keep)), F.lit("***"))


def without_fences(text: Column) -> Column:
    """Text inside a Markdown code fence, or the trimmed text when there is none."""
    inner = F.regexp_replace(F.trim(text), r"^```[A-Za-z]*\s*", "")
    return F.trim(F.regexp_replace(inner, r"\s*```$", ""))
