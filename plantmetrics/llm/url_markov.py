"""URL filter: host and path rules first, a character language-model ratio for the rest; column expressions only.

Two smoothed variable-order Markov models over characters, one for accepted and one for rejected URLs, are counted from the
URLs that the rules decide. They read the whole URL, A-Z lower-cased: scheme, host, path, query and fragment. The chance of a character mixes the counts behind its last 3, 2, 1 and 0 characters: a context of
n occurrences passes 1 / (n + 1) of its weight on to the next shorter one. A URL's score is the mean over its characters of
ln p(accepted) - ln p(rejected); the cut is calibrated on labelled URLs that the counts leave out (those whose md5 begins with
0 to 3), at the largest sum of true-positive and true-negative rate.

The alphabet has 52 signs (other characters count as one), so at most 52^4 four-character strings exist whatever the input;
their log ratios are whole millionths, so sums do not depend on row order. Equal URLs are scored once.

Defined cases: a null url, or one without ://, has an empty host and path and fits no rule; the models judge a null url as an empty
string, one without :// by all its characters; ids are passed through, null or repeated; without labelled URLs every ratio is 0 and the verdict is allow; an empty table
gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_OTHER = r"[^a-z0-9./_~%:$^?#&=+-]"
SIGNS = 52
MICRO = 1_000_000
BIN = 1_000
WIDEST = 5_000


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES: tuple[HostRule, ...] = (
    HostRule("allow", "com", "/"), HostRule("block", "example.com", "/en/"), HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"), HostRule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z lower-cased; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, _AFTER_SCHEME, 1), _UPPER, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[HostRule] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits the host or a parent domain and the path's start; NULL if none."""
    found = None
    for rule in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _ruled(pages: DataFrame, key: str, url: str, rules: Sequence[HostRule]) -> DataFrame:
    whole = F.coalesce(F.translate(F.col(url), _UPPER, _SMALL), F.lit(""))
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), whole.alias("whole"))
    fit = longest_rule(F.col("host"), F.col("path"), rules)
    signs = F.concat(F.lit("^^^"), F.regexp_replace("whole", _OTHER, "*"), F.lit("$"))
    return rows.withColumns({"fit": fit, "signs": signs}).drop("whole")


def _grams(urls: DataFrame, *columns: str) -> DataFrame:
    at = F.sequence(F.lit(1), F.length("signs") - 3)
    return urls.select(*columns, F.explode(F.transform(at, lambda i: F.substr(F.col("signs"), i, F.lit(4)))).alias("gram"))


def _log_ratio(grams: DataFrame) -> DataFrame:
    """(gram, micro) from (gram, yes, no) counts: millionths of ln p(last sign | the three before), accepted less rejected."""
    levels, names = grams, ("yes", "no")
    shorter = {4: grams}
    for n in (3, 2, 1):
        shorter[n] = shorter[n + 1].groupBy(F.substring("gram", 2, n).alias("gram")).agg(*[F.sum(c).alias(c) for c in names])
    for n in (4, 3, 2, 1):
        context = shorter[n].groupBy(F.substring("gram", 1, n - 1).alias("context")).agg(*[F.sum(c).alias(f"{c}_of{n}") for c in names])
        counts = shorter[n].select(F.col("gram").alias("part"), *[F.col(c).alias(f"{c}{n}") for c in names])
        # Tables of n - 1 and, below 4, of n signs have at most 52^3 rows of a few bytes.
        if n < 4:
            part = F.substring("gram", 5 - n, n)
            levels = levels.withColumn("part", part).join(F.broadcast(counts), "part").drop("part")
        else:
            levels = levels.withColumnsRenamed({"yes": "yes4", "no": "no4"})
        context_of = F.substring("gram", 5 - n, n - 1)
        levels = levels.withColumn("context", context_of).join(F.broadcast(context), "context").drop("context")
    chance = {}
    for c in names:
        p = F.lit(1.0 / SIGNS)
        for n in (1, 2, 3, 4):
            p = (F.col(f"{c}{n}") + p) / (F.col(f"{c}_of{n}") + 1)
        chance[c] = p
    return levels.select("gram", F.round((F.ln(chance["yes"]) - F.ln(chance["no"])) * MICRO).cast("long").alias("micro"))


def _cut(scored: DataFrame) -> DataFrame:
    """One row: the cut with the best sum of rates on the labelled URLs left out of the counts, halfway between two of their bins."""
    binned = scored.filter("held").groupBy("bin").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    binned = binned.filter("yes + no > 0")
    # At most 2 * WIDEST + 1 bins.
    rated = binned.selectExpr(
        "bin", "sum(yes) OVER (ORDER BY bin DESC) / nullif(sum(yes) OVER (), 0) AS kept",
        "sum(no) OVER (ORDER BY bin DESC) / nullif(sum(no) OVER (), 0) AS leaked",
        "CAST(ceil((bin + coalesce(lead(bin) OVER (ORDER BY bin DESC), bin)) / 2) AS bigint) AS edge",
    )
    best = rated.filter("kept IS NOT NULL AND leaked IS NOT NULL").selectExpr(
        "struct(round(kept - leaked, 9) AS gain, -abs(edge) AS near, edge) AS x"
    )
    return best.agg(F.coalesce(F.max("x")["edge"], F.lit(0)).alias("cut"))


def judge_urls(
    pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[HostRule] = RULES
) -> DataFrame:
    """key, host, path, rule, verdict, score_bin (thousandths of the mean log ratio) per row."""
    rows = _ruled(pages, key, url, rules)
    label = F.col("fit")["verdict"]
    urls = stored(rows.groupBy("signs").agg(
        F.count_if(F.coalesce(label == "allow", F.lit(False))).alias("yes"),
        F.count_if(F.coalesce(label == "block", F.lit(False))).alias("no"),
    ).withColumn("held", F.substring(F.md5("signs"), 1, 1).between("0", "3")), "urls")
    learned = [F.when(F.col("held"), 0).otherwise(F.col(c)).alias(c) for c in ("yes", "no")]
    counts = _grams(urls.select("signs", *learned), "yes", "no").groupBy("gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    ratios = stored(_log_ratio(stored(counts, "grams")), "ratios")
    total = _grams(urls, "signs").join(ratios, "gram").groupBy("signs").agg(F.sum("micro").alias("micro"), F.count("*").alias("n"))
    mean = F.floor(F.col("micro") / F.col("n") / F.lit(MICRO // BIN))
    scored = stored(
        total.join(urls, "signs").withColumn("bin", F.least(F.greatest(mean, F.lit(-WIDEST)), F.lit(WIDEST)).cast("long")), "scored"
    )
    cut = _cut(scored).first()["cut"]
    judged = rows.join(scored.select("signs", "bin"), "signs")
    by_model = F.when(F.col("bin") >= cut, "allow").otherwise("block")
    return judged.select(
        key, "host", "path", F.col("fit")["rule"].alias("rule"),
        F.coalesce(label, by_model).alias("verdict"), F.col("bin").alias("score_bin"),
    )
