"""Text classes and text fields learnt from marked rows: counted words with smoothing, and contexts ranked by precision.

Both models are small tables (a row per word and class, a row per context) that Spark counts, stores and joins to the words of the
rows; a joined side is broadcast when its stored size is below Spark's threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import small_side, stored

WORD = "[a-z]+"
TOKEN = r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]"
MICRO = 1_000_000
LONGEST_VALUE = 8
_START, _END = "<start>", "<end>"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def learn_classes(marked: DataFrame, text: str, label: str) -> DataFrame:
    """(label, word, micro): a class's millionth-rounded log chance of each known word, add-one smoothed; word NULL holds its prior.

    Rows without a label teach nothing. The table has classes * (words + 1) rows.
    """
    rows = marked.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), _words(F.col(text)).alias("words"))
    seen = stored(rows.select("label", F.explode("words").alias("word")).groupBy("label", "word").agg(F.count("*").alias("n")), "word-counts")
    classes = stored(rows.groupBy("label").agg(F.count("*").alias("rows"), F.sum(F.size("words")).alias("words")), "classes")
    vocabulary = stored(seen.select("word").distinct(), "vocabulary")
    known = vocabulary.count()
    every = classes.collect()  # A row per class.
    total = sum(r.rows for r in every)
    micro = lambda share: F.round(F.log(share) * MICRO).cast("long").alias("micro")
    priors = classes.select("label", F.lit(None).cast("string").alias("word"), micro((F.col("rows") + 1) / F.lit(total + len(every))))
    # Every class has a chance for every word of the vocabulary: that is the model's size.
    cells = vocabulary.select("word", F.explode(F.array(*[F.lit(r.label) for r in every]).cast("array<string>")).alias("label"))
    filled = cells.join(seen, ["label", "word"], "left").join(F.broadcast(classes), "label")  # classes: counted above
    chances = filled.select("label", "word", micro((F.coalesce("n", F.lit(0)) + 1) / (F.col("words") + F.lit(known))))
    return stored(priors.unionByName(chances), "class-model")


def classify_learned(df: DataFrame, key: str, text: str, model: DataFrame, out: str = "predicted") -> DataFrame:
    """(key, out): the class whose prior and words add up to most; ties go to the smaller name, unknown words count for none.

    Keys are unique. Words are joined with the model; sums are whole millionths, so they do not depend on the order of the words.
    """
    weights = small_side(model.filter("word IS NOT NULL").groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("label", "micro"))).alias("by_label")))
    priors = {r.label: r.micro for r in model.filter("word IS NULL").collect()}  # A row per class.
    if not priors:
        return df.select(key, F.lit(None).cast("string").alias(out))
    words = df.select(key, F.explode(_words(F.col(text))).alias("word")).join(weights, "word")
    sums = words.groupBy(key).agg(*[F.sum(F.element_at("by_label", F.lit(c))).alias(f"_{i}") for i, c in enumerate(sorted(priors))])
    scored = df.select(key).join(sums, key, "left")
    # Smaller names come first among equals, as their place is negated.
    places = [F.struct((F.coalesce(f"_{i}", F.lit(0)) + F.lit(priors[c])).alias("micro"), F.lit(-i).alias("place"), F.lit(c).alias("label")) for i, c in enumerate(sorted(priors))]
    return scored.select(key, F.array_max(F.array(*places))["label"].alias(out))


def _tokens(text: Column) -> Column:
    """Tokens between three start signs and an end sign."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return F.concat(F.array(*[F.lit(_START)] * 3), found, F.array(F.lit(_END)))


def _lefts(at: Column) -> Column:
    """The one, two and three tokens before a place."""
    return F.array(*[F.concat_ws(" ", F.slice("tokens", at - k, F.lit(k))) for k in (1, 2, 3)])


def _places(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """Places of the rows' tokens with the contexts (left, right, ...) they stand in. `at` counts from 1.

    Places without a context's last token before them are dropped first, so few are spelled out with their longer contexts.
    """
    lasts = small_side(contexts.select(F.substring_index("left", " ", -1).alias("_last")).distinct())
    every = rows.withColumn("at", F.explode(F.sequence(F.lit(4), F.size("tokens"))))
    near = every.withColumn("_last", F.get("tokens", F.col("at") - 2)).join(lasts, "_last", "left_semi").drop("_last")
    return near.withColumn("left", F.explode(_lefts(F.col("at")))).join(contexts, "left")


def _reach(right: str) -> Column:
    """Tokens from `at` up to the first `right`, or NULL if it does not come within LONGEST_VALUE tokens or at once."""
    ahead = F.slice("tokens", F.col("at"), LONGEST_VALUE + 1)
    length = F.array_position(ahead, F.col(right)) - 1
    return F.when(length > 0, F.concat_ws(" ", F.slice(ahead, 1, length.cast("int"))))


def learn_contexts(
    marked: DataFrame, key: str, text: str, value: str, least: int = 3, precision: float = 0.9
) -> DataFrame:
    """(left, right, taken, right_ones, precision, rank): contexts of marked values, the surest first.

    A context is up to three tokens before the value and the token behind it. Those that occur round at least `least` marked values
    are tried on every marked row (a NULL value marks a text without the field); a context stays if the share of its finds that are
    the marked value is `precision` or more. Values are compared token by token, joined by one space.
    """
    normal = F.concat_ws(" ", F.regexp_extract_all(F.col(value), F.lit(TOKEN), F.lit(0)))
    rows = marked.select(key, F.col(text).alias("text"), F.when(F.col(value).isNotNull(), normal).alias("want"))
    texts = stored(rows.select(key, "want", _tokens(F.col("text")).alias("tokens")), "tokens")  # A row per text, not per place.
    size = F.size(F.split("want", " "))
    begins = F.filter(F.sequence(F.lit(4), F.size("tokens")), lambda i: F.concat_ws(" ", F.slice("tokens", i, size)) == F.col("want"))
    values = texts.filter(size <= LONGEST_VALUE).select(key, "want", "tokens", F.explode(begins).alias("at"))
    behind = F.get("tokens", F.col("at") + size - 1).alias("right")
    seen = values.select(key, F.explode(_lefts(F.col("at"))).alias("left"), behind).distinct()
    contexts = small_side(seen.groupBy("left", "right").agg(F.count("*").alias("n")).filter(F.col("n") >= least).drop("n"))
    tried = _places(texts, contexts).withColumn("found", _reach("right")).filter("found IS NOT NULL")
    hit = F.coalesce(F.col("found") == F.col("want"), F.lit(False)).cast("long")
    judged = tried.groupBy("left", "right").agg(F.count("*").alias("taken"), F.sum(hit).alias("right_ones"))
    share = judged.withColumn("precision", F.col("right_ones") / F.col("taken")).filter(F.col("precision") >= precision)
    # Contexts of a text's own wording: few, and counted by now.
    order = Window.orderBy(F.desc("precision"), F.desc("right_ones"), F.desc(F.length("left")), "left", "right")
    return stored(share.withColumn("rank", F.row_number().over(order)), "contexts")


def extract_learned(df: DataFrame, key: str, text: str, contexts: DataFrame, out: str) -> DataFrame:
    """(key, out): the value in the surest context of each text, the earliest place among equals; NULL where none fits. Keys are unique."""
    texts = df.select(key, _tokens(F.col(text)).alias("tokens"))
    found = _places(texts, small_side(contexts.select("left", "right", "rank"))).withColumn("value", _reach("right")).filter("value IS NOT NULL")
    first = found.groupBy(key).agg(F.min(F.struct("rank", "at", "value"))["value"].alias(out))
    return df.select(key).join(first, key, "left")
