"""Mixing sources to target weights by hierarchical budgets.

Documents hang below a tree domain / language / source. The budget flows down by the weights of each node's children; a child
can take at most `max_epochs` times the tokens below it, and what it cannot take goes to its siblings by their weights. Only when
all siblings are full does a shortage show further up, where the parent's siblings share it, because a node's capacity is the sum
of its leaves'. The shares of one set of siblings are least(capacity, weight * level) with the level that uses the budget up.

A leaf's budget is spent on whole epochs first; of the last, begun epoch it takes the token prefix in the order of
md5(seed:epoch:id). The cut is found from sums of 4,096 ranges of that order, then of 4,096 ranges inside the one that is cut, then
of the places in one of these. Sums are built before the shuffle, also of rows of one place (equal or null ids), so no task sees
a whole leaf and no text is shuffled.

Defined cases: null domain, language or source are a child named 'null'; a null text has no tokens, and documents without tokens
belong to every epoch their leaf reaches in order; a source without a domain is in domain 'other'; equal ids (or null ones) share a
place in the order and are taken together; a leaf never exceeds its budget; an empty table gives no rows; extra columns are kept by
`mix` as they are, and if one is named like an added column, the added one gets an underscore behind its name.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.llm.words import WORD

_LEVELS = ("m_domain", "m_lang", "m_source")
#: Digits of the ranges that a cut is narrowed down to, one after the other; 0 stands for whole places.
_DIGITS = (3, 6, 0)


@dataclass(frozen=True)
class Mix:
    """Weights by child name (1 if not named, 0 leaves it out), domains by source, and the budget as a share of all tokens."""

    domains: Mapping[str, str] = field(default_factory=lambda: {f"src{k}": ("web", "news", "books", "reference")[k // 5] for k in range(20)})
    domain_weights: Mapping[str, float] = field(default_factory=lambda: {"web": 4.0, "news": 3.0, "books": 2.0, "reference": 2.0})
    lang_weights: Mapping[str, float] = field(default_factory=lambda: {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0})
    source_weights: Mapping[str, float] = field(default_factory=dict)
    budget_share: float = 0.75
    max_epochs: int = 4
    seed: int = 7


def _named(values: Mapping, column: Column, default) -> Column:
    out = None
    for name, value in values.items():
        out = F.when(column == name, F.lit(value)) if out is None else out.when(column == name, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def _leaf_columns(mix: Mix, lang: str, source: str) -> dict[str, Column]:
    return {
        "m_domain": _named(mix.domains, F.coalesce(F.col(source), F.lit("")), "other"),
        "m_lang": F.coalesce(F.col(lang), F.lit("null")), "m_source": F.coalesce(F.col(source), F.lit("null")),
    }


def _place(mix: Mix, epoch: Column, key: Column) -> Column:
    """Position of a document in one epoch's order."""
    return F.md5(F.concat(F.lit(f"{mix.seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(key.cast("string"), F.lit("null"))))


def _shared_out(nodes: DataFrame, parents: list[str], name: str, weights: Mapping[str, float]) -> DataFrame:
    """`given` per child of each parent's `budget`, from `capacity` and weights."""
    weighted = nodes.withColumn("w", _named(weights, F.col(name), 1.0).cast("double")).filter("w > 0")
    order = Window.partitionBy(*parents).orderBy(F.col("capacity") / F.col("w"), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.col("budget") - before) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    levelled = weighted.withColumn("level", level).withColumn("level", F.max("level").over(Window.partitionBy(*parents)))
    return levelled.withColumn("given", F.least("capacity", F.col("w") * F.col("level"))).drop("w", "level", "budget")


def leaf_budgets(light: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, budget, epochs, rest) per leaf: whole epochs and the tokens of the begun one."""
    leaves = light.groupBy(*_LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = stored(leaves.withColumn("capacity", F.col("tokens").cast("double") * mix.max_epochs), "leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"]
    given = None
    for depth, weights in enumerate((mix.domain_weights, mix.lang_weights, mix.source_weights), 1):
        path = list(_LEVELS[:depth])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        if given is None:
            nodes = nodes.withColumn("budget", F.lit(float(total) * mix.budget_share))
        else:
            nodes = nodes.join(given.select(*path[:-1], F.col("given").alias("budget")), path[:-1])
        given = _shared_out(nodes, path[:-1], path[-1], weights)
    whole = F.floor(F.col("given") + 1e-6).cast("long")
    budgets = leaves.drop("capacity").join(given.drop("capacity"), list(_LEVELS)).withColumn("budget", whole).drop("given")
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.greatest(F.col("tokens"), F.lit(1)))).otherwise(F.lit(0)).cast("int")
    return budgets.withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def leaf_cuts(light: DataFrame, mix: Mix) -> DataFrame:
    """leaf_budgets with `last`: the last place of the begun epoch that the rest pays for (empty if none)."""
    budgets = stored(leaf_budgets(light, mix), "budgets")
    placed = light.join(budgets.drop("tokens", "budget", "rest"), list(_LEVELS)).withColumn("place", _place(mix, F.col("epochs") + 1, F.col("id")))
    both = budgets
    cut = budgets.select(*_LEVELS, F.lit("").alias("within"), F.col("rest").alias("left"))
    ends = []
    for digits in _DIGITS:
        here = placed.join(cut, list(_LEVELS)).filter(F.col("within") == F.substring("place", F.lit(1), F.length("within")))
        part = F.substring("place", 1, digits) if digits else F.col("place")
        sums = here.groupBy(*_LEVELS, part.alias("part"), "left").agg(F.sum("n_tokens").alias("n"), F.max("place").alias("end"))
        up_to = Window.partitionBy(*_LEVELS).orderBy("part")
        summed = stored(sums.withColumn("through", F.sum("n").over(up_to)), "ranges")
        end = f"last_{digits}"
        both = both.join(summed.filter("through <= left").groupBy(*_LEVELS).agg(F.max("end").alias(end)), list(_LEVELS), "left")
        cut = summed.filter("through > left AND through - n <= left").select(
            *_LEVELS, F.col("part").alias("within"), (F.col("left") - F.col("through") + F.col("n")).alias("left"))
        ends.append(end)
    last = F.greatest(F.lit(""), *[F.coalesce(e, F.lit("")) for e in ends])
    return both.withColumn("last", last).drop(*ends)


def _free(name: str, taken: list[str]) -> str:
    """`name`, with underscores behind it as long as a column has that name."""
    lower = {c.lower() for c in taken}
    while name in lower:
        name += "_"
    return name


def mix(docs: DataFrame, plan: Mix = Mix(), key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Every document once per epoch it is taken in, with its columns and `mix_domain`, `mix_epoch` (from 1), named as `_free` has it."""
    tokens = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    light = stored(docs.select(F.col(key).alias("id"), tokens.alias("n_tokens"), *[c.alias(n) for n, c in _leaf_columns(plan, lang, source).items()]), "tokens")
    cuts = stored(leaf_cuts(light, plan).select(*_LEVELS, "epochs", "last"), "cuts")
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("own"), F.col(key).alias("id"), *[c.alias(n) for n, c in _leaf_columns(plan, lang, source).items()])
    times = F.col("epochs") + (_place(plan, F.col("epochs") + 1, F.col("id")) <= F.col("last")).cast("int")
    taken = own.join(cuts, list(_LEVELS)).withColumn("times", times).filter("times > 0")
    repeated = taken.withColumn("mix_epoch", F.explode(F.sequence(F.lit(1), F.col("times"))))
    added = {"m_domain": "mix_domain", "mix_epoch": "mix_epoch"}
    named = [F.col(c).alias(_free(n, docs.columns)) for c, n in added.items()]
    return repeated.select(*[F.col("own")[c].alias(c) for c in docs.columns], *named)
