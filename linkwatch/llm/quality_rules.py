"""Quality rules with risk-controlled cutoffs, in DataFrame expressions only.

Each rule rejects a document whose share of something exceeds a cutoff.  The
cutoffs are chosen per stratum on labelled documents: a candidate is certified
when the exact binomial test rejects "this rule loses more than its part of the
allowed false rejections" at a level corrected for all rules, strata and
candidates.  Among the certified the most useful one is taken; a stratum with
too few labels gets none and loses no document to the rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch.llm.common import SPACE_CHARS, SPACE_CLASS, fresh, landed

BROADCAST_STRATA = 10_000
# from here on the lower terms of a binomial tail are bounded by a geometric series
TAIL_TERMS = 20_000


@dataclass(frozen=True)
class Risk:
    """Per stratum at most ``rate`` of good documents are lost, with ``confidence``."""

    rate: float = 0.05
    confidence: float = 0.95
    penalty: float = 10.0
    cutoffs: tuple[float, ...] = (
        0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9,
    )


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate a value once, whatever number of lambdas inside ``use`` refer to it."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, window: int) -> Column:
    """Words covered by windows that occur twice or more, the first one included.

    Windows are compared by a 64-bit hash.  Sorting them brings equal ones
    together, so the work is n log n in the words of a text.
    """
    size = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(1), size - (window - 1)),
        lambda i: F.xxhash64(F.slice(words, i, window)),
    )

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = bound(
            placed,
            lambda s: F.filter(
                s,
                lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
            ),
        )
        places = F.array_sort(F.transform(again, lambda x: x["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(-window).alias("last"), F.lit(0).alias("total")),
            lambda a, x: F.struct(
                x.alias("last"), (a["total"] + F.least(F.lit(window), x - a["last"])).alias("total")
            ),
            lambda a: a["total"],
        )

    counted = bound(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )
    return F.when(size <= window, F.lit(0)).otherwise(counted)


RULES: dict[str, Callable[[Column], Column]] = {
    "symbols": lambda m: m["n_symbols"] / m["word_chars"],
    "exclaims": lambda m: m["n_exclaims"] / m["word_chars"],
    "capitals": lambda m: m["n_capitals"] / m["word_chars"],
    "lines": lambda m: m["n_dup_lines"] / m["n_lines"],
    "repeats": lambda m: m["n_repeat_words"] / m["n_words"],
}


def measured(docs: DataFrame, name: str, text_col: str = "text", window: int = 8) -> DataFrame:
    """Add the counts of each whole text as struct ``name``.

    Words are runs without ASCII white space.  A null or blank text has no
    words and counts of zero.  Other columns stay as they are.
    """
    blank = F.trim(F.coalesce(F.col(text_col), F.lit("")), F.lit(SPACE_CHARS))
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACE_CHARS)) != "")
    split = docs.withColumn(
        name,
        F.struct(
            F.when(blank == "", F.array().cast("array<string>"))
            .otherwise(F.split(blank, SPACE_CLASS + "+"))
            .alias("words"),
            lines.alias("lines"),
        ),
    )
    words, lines = F.col(f"{name}.words"), F.col(f"{name}.lines")
    return split.withColumn(
        name,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclaims"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words, window).cast("long").alias("n_repeat_words"),
        ),
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def log_factorial(n: Column) -> Column:
    """Exact up to 20, Stirling's series with an error below 1e-13 beyond."""
    x = n.cast("double") + 1
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5))
    stirling = (x - 0.5) * F.ln(x) - x + F.lit(0.9189385332046727) + series
    return F.when(n <= 20, F.ln(F.factorial(F.least(n, F.lit(20)).cast("int")))).otherwise(stirling)


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) of a binomial variable with n trials, 1 where k reaches the mean."""
    log_top = (
        log_factorial(n)
        - log_factorial(k)
        - log_factorial(n - k)
        + k * F.log(F.lit(rate))
        + (n - k) * F.log1p(F.lit(-rate))
    )
    ratio = lambda i: i / (n - i + 1) * ((1 - rate) / rate)
    sums = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.least(k, F.lit(TAIL_TERMS))),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total")),
        lambda a, j: F.struct(
            (a["term"] * ratio(k - j)).alias("term"), (a["total"] + a["term"]).alias("total")
        ),
        lambda a: a["total"] + F.when(k > TAIL_TERMS, a["term"] / (1 - ratio(k))).otherwise(0.0),
    )
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_top) * sums))


def calibrated(
    known: DataFrame, labels: DataFrame, risk: Risk = Risk(), label_col: str = "quality"
) -> DataFrame:
    """Certified cutoffs: a row per stratum with a column per rule (null: none).

    ``known`` has doc_id, stratum and measures ``m``.  A document is good when
    every label it has says 1; null labels are ignored.  Documents the base
    rules reject don't take part.  Every labelled document is counted, in a
    histogram over the candidates.
    """
    marks = labels.where(F.col(label_col).isNotNull()).groupBy("doc_id")
    marks = marks.agg((F.min(label_col) == 1).alias("good"))
    shares = F.array(
        *[
            F.struct(F.lit(k).alias("rule"), F.coalesce(f(F.col("m")), F.lit(0.0)).alias("share"))
            for k, f in RULES.items()
        ]
    )
    above = F.array(*[F.lit(c) for c in risk.cutoffs])
    counts = (
        known.where(~base_failed(F.col("m")))
        .select("doc_id", "stratum", F.explode(shares).alias("r"))
        .select(
            "doc_id",
            "stratum",
            "r.rule",
            F.size(F.filter(above, lambda c: F.col("r.share") > c)).alias("passed"),
        )
        .join(marks, "doc_id")
        .groupBy("stratum", "rule", "passed")
        .agg(
            F.count_if("good").alias("good"),
            F.count_if(~F.col("good")).alias("bad"),
        )
    )
    counts = landed(counts, "rule-counts")
    strata = max(1, counts.select("stratum").distinct().count())
    level = (1 - risk.confidence) / (len(RULES) * strata * len(risk.cutoffs))

    def lost(kind: str) -> Column:
        beyond = F.filter("bins", lambda b: b["passed"] > F.col("at"))
        return F.aggregate(beyond, F.lit(0).cast("long"), lambda a, b: a + b[kind])

    rejected = (
        counts.groupBy("stratum", "rule")
        .agg(
            F.collect_list(F.struct("passed", "good", "bad")).alias("bins"),
            F.sum("good").alias("n_good"),
            F.sum("bad").alias("n_bad"),
        )
        .select("*", F.posexplode(above).alias("at", "cutoff"))
        .withColumns({"good_lost": lost("good"), "bad_lost": lost("bad")})
    )
    tail = binomial_tail(F.col("good_lost"), F.col("n_good"), risk.rate / len(RULES))
    useful = F.col("bad_lost") / F.col("n_bad") - risk.penalty * F.col("good_lost") / F.col("n_good")
    best = (
        rejected.where((tail <= level) & (useful > 0))
        .groupBy("stratum", "rule")
        .agg(F.max(F.struct(useful.alias("useful"), "cutoff"))["cutoff"].alias("cutoff"))
    )
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == k, F.col("cutoff"))).alias(k) for k in RULES]
    )


def judged(rows: DataFrame, name: str, stratum: Column, cutoffs: DataFrame, kept: str) -> DataFrame:
    """Add the verdict ``kept`` to rows that have the measures ``name``."""
    rules = landed(cutoffs, "rule-cutoffs").select(F.struct("*").alias(f"{name}_cutoffs"))
    if rules.count() <= BROADCAST_STRATA:
        rules = F.broadcast(rules)
    cut, m = F.col(f"{name}_cutoffs"), F.col(name)
    breaks = F.lit(False)
    for k, share in RULES.items():
        breaks = breaks | F.coalesce(share(m) > cut[k], F.lit(False))
    joined = rows.join(rules, stratum == cut["stratum"], "left")
    return joined.withColumn(kept, ~base_failed(m) & ~breaks).drop(f"{name}_cutoffs")


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    risk: Risk = Risk(),
    stratum_col: str = "lang",
    carried: tuple[str, ...] | None = None,
) -> DataFrame:
    """The documents with their measures (struct) and verdict, computed once.

    Returns the columns ``carried`` (all of ``docs``), a struct of measures and a boolean, the
    last two as the last columns, whatever their names.  A null stratum is the
    stratum of the empty string.  Rows that repeat an id are judged one by one.
    An empty table, or one without labels, gives the base rules' verdict.
    """
    name = fresh(docs.columns, "measures")
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit(""))
    keep = dict.fromkeys((*(carried or docs.columns), "doc_id", stratum_col))
    rows = landed(measured(docs, name).select(*keep, name), "measured")
    known = rows.select("doc_id", stratum.alias("stratum"), F.col(name).alias("m"))
    return judged(rows, name, stratum, calibrated(known, labels, risk), fresh(rows.columns, "kept"))


def kept_documents(
    docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), stratum_col: str = "lang"
) -> DataFrame:
    judged_rows = quality_verdicts(docs, labels, risk, stratum_col)
    return judged_rows.where(F.col(judged_rows.columns[-1])).select(*docs.columns)
