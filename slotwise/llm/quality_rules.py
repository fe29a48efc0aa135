"""Operator 9: quality rules whose cutoffs carry a statistical guarantee.

Every rule rejects a document when one feature of its text exceeds a cutoff.
Cutoffs are not set by hand. Documents with a quality label are the holdout:
for each stratum (language), rule and candidate cutoff the good documents the
rule would reject are counted, and the exact binomial tail says how likely so
few would be if the true false-rejection rate were above the limit. Cutoffs of
one rule are tested from lenient to strict and the sequence ends at the first
failure (a fixed sequence keeps its error level), and the level is divided by
the number of strata times rules (Bonferroni). Among the certified cutoffs the
one is taken that rejects most bad documents net of ``good_weight`` good ones;
a rule that gains nothing stays off. With probability ``1 - delta`` no stratum
loses more than ``alpha`` of its good documents to the rules.

As many strata are tested, those of most good labels first and ``max_strata``
at most, as have labels enough to certify a spotless rule among that many. In
all others, and in languages without labels, no cutoff can be certified and
only the base rules reject. Only DataFrame functions are used.

Defined cases: a null text counts as an empty one and fails the base rules; a
null language is a language of its own; a document labelled more than once
counts once, as good if any label says good; labels without a quality or
doc_id are ignored; repeated documents are judged row by row; without labels
only the base rules reject. Columns other than doc_id, text and lang are never
read, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotwise.llm.common import let, words_of, written

SYMBOLS = "#*$%&|<>"

#: Rules by feature; a document is rejected above the cutoff. Candidates run
#: from lenient to strict.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02),
    "dup_line_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "repeat_share": (0.48, 0.45, 0.4, 0.35, 0.3),
    "upper_share": (0.9, 0.7, 0.5, 0.3, 0.2, 0.15, 0.1),
    "shout_share": (0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03),
    "same_word_share": (0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6),
}


@dataclass(frozen=True)
class RiskParams:
    alpha: float = 0.01  #: false-rejection rate allowed per stratum, over all rules
    delta: float = 0.05  #: probability that any guarantee fails
    good_weight: float = 20.0  #: bad documents that one lost good document outweighs
    max_strata: int = 1024  #: strata with cutoffs of their own

    @property
    def rule_alpha(self) -> float:
        return self.alpha / len(RULES)


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _windows(words: Column, key) -> Column:
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: key(i, w, F.get(words, i + 1), F.get(words, i + 2)),
    )


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in ``words``.

    Hashed windows tell cheaply whether any can repeat. If so, the windows
    themselves are sorted with their positions, so equal ones are neighbours,
    and the positions of the repeated ones are sorted back to add up the cover.
    """
    text_and_place = lambda i, *w: F.struct(F.concat_ws(" ", *w).alias("k"), i.alias("p"))
    repeated = lambda s: F.filter(
        s, lambda x, i: F.coalesce((i > 0) & (F.get(s, i - 1)["k"] == x["k"]), F.lit(False)) | F.coalesce(F.get(s, i + 1)["k"] == x["k"], F.lit(False))
    )
    cover = lambda p: F.aggregate(
        F.transform(p, lambda v, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - v, F.lit(3)))), F.lit(0), lambda a, x: a + x
    )
    starts = let(F.array_sort(_windows(words, text_and_place)), lambda s: F.array_sort(F.transform(repeated(s), lambda x: x["p"])))
    no_repeat = let(_windows(words, lambda i, *w: F.xxhash64(*w)), lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(no_repeat, F.lit(0)).otherwise(let(starts, cover))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``m``: a struct of counts and rule features per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    from_words = lambda w: F.struct(
        F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words"), F.size(F.array_distinct(w)).alias("n_distinct")
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    from_lines = lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))
    counted = docs.select(
        *keep,
        let(words_of(F.col("text")), from_words).alias("w"),
        let(lines, from_lines).alias("l"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        _removed(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).alias("n_upper"),
        _removed(text, "!?").alias("n_shout"),
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    n_words = F.col("w.n_words").cast("long")
    repeat = F.col("w.n_repeat_words").cast("long")
    return counted.select(
        *keep,
        F.struct(
            n_words.alias("n_words"),
            "word_chars",
            "n_symbols",
            F.col("l.n_dup_lines").cast("long").alias("n_dup_lines"),
            repeat.alias("n_repeat_words"),
            ((n_words < 50) | (100 * repeat > 50 * n_words)).alias("base_failed"),
            share("n_symbols", "word_chars").alias("symbol_share"),
            share("l.n_dup_lines", "l.n_lines").alias("dup_line_share"),
            share("w.n_repeat_words", "w.n_words").alias("repeat_share"),
            share("n_upper", "word_chars").alias("upper_share"),
            share("n_shout", "word_chars").alias("shout_share"),
            (1 - share("w.n_distinct", "w.n_words")).alias("same_word_share"),
        ).alias("m"),
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial(n, p), summed in logarithms term by term.

    Exact up to rounding; 1 where ``k > n p``, where no test can pass anyway,
    which bounds the sum to ``n p`` terms.
    """
    odds = math.log(p) - math.log1p(-p)
    first = n * F.lit(math.log1p(-p))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log((n - j + 1) / j) + odds
        top = F.greatest(acc["total"], term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(acc["total"] - top) + F.exp(term - top))).alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    total = F.aggregate(terms, F.struct(first.alias("term"), first.alias("total")), add, lambda a: F.exp(a["total"]))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), total))


def holdout(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents that pass the base rules: stratum, good, m."""
    marks = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg((F.max("quality") > 0).alias("good"))
    )
    return features.where(~F.col("m.base_failed")).join(marks, "doc_id").select("stratum", "good", "m")


def cutoffs(holdout: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """One row per stratum with a column per rule (null: the rule is off); ``max_strata`` at most."""
    # Per language the number of documents in each cell of each rule's grid:
    # all that later steps need, and at most a few hundred rows per language.
    grid = F.array(*(
        F.struct(
            F.lit(r).alias("rule"),
            sum(((F.col(f"m.{r}") > c).cast("int") for c in cs), F.lit(0)).alias("cell"),
        )
        for r, cs in RULES.items()
    ))
    cells = holdout.select("stratum", "good", F.inline(grid)).groupBy("stratum", "rule", "cell").agg(
        F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")
    )
    cells = written(cells, "cells")
    # The numbers of good labels alone decide who is tested, so that choice
    # costs no error level.
    needed = lambda strata: math.log(params.delta / (strata * len(RULES))) / math.log1p(-params.rule_alpha)
    largest = (
        cells.where(F.col("rule") == next(iter(RULES)))
        .groupBy("stratum").agg(F.sum("good").alias("n")).where(F.col("n") >= needed(1))
        .orderBy(F.desc("n"), "stratum").limit(params.max_strata).collect()
    )
    n_own = max((i for i, r in enumerate(largest, 1) if r["n"] >= needed(i)), default=0)
    cells = cells.where(F.col("stratum").isin([r["stratum"] for r in largest[:n_own]]))
    # ``cell`` counts the cutoffs exceeded, strictest first, so step s rejects
    # the cells above size - s.
    steps = F.explode(F.sequence(F.lit(1), F.col("size")))
    sizes = F.create_map(*(x for r, cs in RULES.items() for x in (F.lit(r), F.lit(len(cs)))))
    hits = lambda side: F.sum(F.when(F.col("cell") > F.col("size") - F.col("step"), F.col(side)).otherwise(0))
    tests = (
        cells.withColumn("size", sizes[F.col("rule")]).withColumn("step", steps)
        .groupBy("stratum", "rule", "step")
        .agg(hits("good").alias("lost"), hits("bad").alias("caught"), F.sum("good").alias("n"))
    )
    strata = W.partitionBy("rule", "step")
    tests = tests.withColumn("strata", F.count("*").over(strata))
    passed = binomial_tail(F.col("lost"), F.col("n"), params.rule_alpha) <= F.lit(params.delta) / (F.col("strata") * len(RULES))
    sequence = W.partitionBy("stratum", "rule").orderBy("step")
    gain = F.col("caught") - params.good_weight * F.col("lost")
    grids = F.create_map(*(x for r, cs in RULES.items() for x in (F.lit(r), F.array(*map(F.lit, cs)))))
    best = (
        tests.withColumn("certified", F.min(passed).over(sequence))
        .where(F.col("certified") & (gain > 0))
        .groupBy("stratum", "rule").agg(F.max(F.struct(gain.alias("gain"), (-F.col("step")).alias("step"))).alias("best"))
        .select("stratum", "rule", F.element_at(F.element_at(grids, F.col("rule")), -F.col("best.step")).alias("cutoff"))
    )
    return written(best.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(r) for r in RULES)), "cutoffs")


def judged(features: DataFrame, limits: DataFrame) -> DataFrame:
    """``features`` (with stratum and m) plus ``kept``; ``limits`` come from :func:`cutoffs`.

    ``limits`` has at most ``max_strata`` rows, so it is broadcast.
    """
    own = limits.select(F.col("stratum").alias("_own"), F.struct(*RULES).alias("_limits"))
    joined = features.join(F.broadcast(own), F.col("stratum") == F.col("_own"), "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(F.col(f"m.{r}") > F.col(f"_limits.{r}"), F.lit(False))
    return joined.withColumn("kept", ~F.col("m.base_failed") & ~rejected).drop("_own", "_limits")


def judge(docs: DataFrame, labels: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """doc_id, stratum, m, kept of every row of ``docs``.

    The features are written once: the holdout and the verdicts both read them.
    """
    columns = ["doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum")]
    features = written(measured(docs.select(*columns), ["doc_id", "stratum"]), "features")
    return judged(features, cutoffs(holdout(features, labels), params))


def keep_good(docs: DataFrame, labels: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the rules keep.

    Texts are measured twice, for the holdout and in place, and never shuffled.
    The line number is tested with the verdict: a filter on a column that is not
    a function of the row stays above the projection, instead of being pushed
    down with a second copy of all measures.
    """
    line = F.monotonically_increasing_id().alias("_line")
    stratum = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum")
    once = measured(docs.select("doc_id", "text", stratum), ["doc_id", "stratum"]).select("*", line).where("_line >= 0 AND NOT m.base_failed")
    limits = cutoffs(holdout(once, labels), params)
    rows = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), stratum)
    return judged(measured(rows, ["row", "stratum"]).select("*", line), limits).where("kept AND _line >= 0").select("row.*")
