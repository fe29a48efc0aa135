"""Operator 8: personal data by fixed patterns and bootstrapped contexts.

The base patterns find e-mail addresses, IP addresses, card and phone numbers.
They seed a bootstrap: every identifier-like token (it holds a digit or an
``@``) is an instance, the two words before it (an earlier token among them
stands as ``<ID>``) are its lexical pattern, and each pair of instance and
pattern seen anywhere is an edge of a bipartite graph. Confidence
starts at 1 for instances a base span covers and 0 for all others, and runs
along the edges for ``rounds`` rounds: a pattern's confidence is the mean of
its instances' (with ``smoothing`` added to the divisor), an instance's is the
noisy-or of its patterns'. Tokens not yet covered whose pattern reached
``confidence`` and was induced by ``support`` different instances become spans
of kind ``context``.

Edges are grouped before any join and confidences travel as plain sums, so a
pattern or an instance shared by a third of all texts costs one row per task.
Only DataFrame functions are used.

Defined cases: a null text counts as empty; repeated rows are each scanned and
give the same spans; a token among the first two words of a text has no pattern
and is never added. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm import spans as S
from slotwise.llm.common import let, words_of, written

# The base patterns and the order of kinds. Lookbehinds, \G and
# possessive quantifiers only spare restarts inside a run that has failed.
KINDS = ("email", "ip", "card", "phone", "context")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: An identifier-like token: a word that holds a digit or an @.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: What stands for an identifier-like token among the two words before another.
ID = "<ID>"


@dataclass(frozen=True)
class BootstrapParams:
    rounds: int = 3
    confidence: float = 0.95
    support: int = 10  #: different instances that must induce a pattern
    smoothing: float = 0.25


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weigh(d: Column, i: Column) -> Column:
        v = d.cast("int")
        twice = F.when(v > 4, v * 2 - 9).otherwise(v * 2)
        return F.when(i % 2 == 1, twice).otherwise(v)

    places = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(places, weigh), F.lit(0), lambda a, v: a + v) % 10 == 0


def _card(t: Column) -> Column:
    return let(_digits(t), lambda d: F.length(d).between(14, 19) & _luhn(d))


def _ip(t: Column) -> Column:
    part = lambda p: let(F.regexp_replace(p, "^0+", ""), lambda x: (F.length(x) <= 2) | ((F.length(x) == 3) & (x <= "255")))
    return F.forall(F.split(t, r"\."), part)


def base_spans(text: Column) -> Column:
    """Spans of the four base kinds; ``text`` must not be null."""
    return F.concat(
        S.guarded(F.contains(text, F.lit("@")), S.matches(text, EMAIL, 0)),
        S.guarded(text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), S.matches(text, IP, 1, _ip)),
        S.guarded(text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), S.matches(text, CARD, 2, _card)),
        S.guarded(F.contains(text, F.lit("+")), S.matches(text, PHONE, 3, lambda t: F.length(_digits(t)).between(10, 15))),
    )


def tokens(text: Column) -> Column:
    """Identifier-like tokens: array of struct (s, k, e, t, left), left: the two words before."""
    def lefts(words: Column) -> Column:
        # A token is a whole word, so the words that hold a digit or an @ are
        # the tokens in order. Words are lower case, so none equals <ID>.
        known = F.transform(words, lambda w: F.when(w.rlike("[0-9@]"), F.lit(ID)).otherwise(F.lower(w)))
        before = lambda k, i: F.when(i < 2, F.lit("")).otherwise(F.concat(F.get(k, i - 2), F.lit(" "), F.get(k, i - 1), F.lit(" ")))
        return let(known, lambda k: F.filter(F.transform(k, lambda w, i: F.when(w == ID, before(k, i))), lambda g: g.isNotNull()))

    with_left = lambda found: F.zip_with(
        found, let(words_of(text), lefts), lambda x, g: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["t"].alias("t"), g.alias("left"))
    )
    kind = "array<struct<s:bigint,k:int,e:bigint,t:string,left:string>>"
    some = let(S.matches(text, TOKEN, 4), lambda m: F.when(F.size(m) == 0, F.array().cast(kind)).otherwise(with_left(m)))
    return F.when(text.rlike("[0-9@]"), some).otherwise(F.array().cast(kind))


def scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` with base spans and identifier-like tokens (``covered``: a base span touches it)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    got = docs.select(*keep, let(text, base_spans).alias("base"), tokens(text).alias("tokens"))
    return got.select(*keep, "base", F.transform("tokens", lambda x: F.struct(
        x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["t"].alias("t"), x["left"].alias("left"), S.overlaps(x, F.col("base")).alias("covered")
    )).alias("tokens"))


def confident_patterns(scan: DataFrame, params: BootstrapParams = BootstrapParams()) -> DataFrame:
    """Patterns (left) that reach the confidence, from the pattern-instance graph."""
    seen = scan.select(F.explode("tokens").alias("x")).select("x.*").where(F.col("left").rlike(r"[^ ] [^ ]+ $"))
    edges = written(seen.groupBy("left", "t").agg(F.max("covered").alias("seed")), "pii_edges")
    seeds = edges.groupBy("t").agg(F.max("seed").alias("seed"))
    trust = written(seeds.select("t", F.col("seed").cast("double").alias("trust"), "seed"), "pii_trust_0")
    for n in range(1, params.rounds + 1):
        patterns = written(
            edges.join(trust, "t").groupBy("left").agg(
                (F.sum("trust") / (F.count("*") + params.smoothing)).alias("confidence"),
                F.sum(trust["seed"].cast("long")).alias("support"),
            ).where(F.col("confidence") > 0),
            f"pii_patterns_{n}",
        )
        if n == params.rounds:
            break
        # Noisy-or in logarithms; a seed keeps its full trust.
        doubt = edges.select("left", "t").join(patterns, "left").groupBy("t").agg(F.sum(F.log1p(-F.least("confidence", F.lit(0.999999)))).alias("doubt"))
        trust = written(
            trust.select("t", "seed").join(doubt, "t", "left")
            .select("t", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp(F.coalesce("doubt", F.lit(0.0)))).alias("trust"), "seed"),
            f"pii_trust_{n}",
        )
    return patterns.where((F.col("confidence") >= params.confidence) & (F.col("support") >= params.support)).select("left")


def added_spans(scan: DataFrame, key: list[str], params: BootstrapParams = BootstrapParams()) -> DataFrame:
    """``key`` and the spans that confident patterns add, one row per row of ``scan`` with any."""
    loose = scan.select(*key, F.explode(F.filter("tokens", lambda x: ~x["covered"])).alias("x"))
    hits = loose.select(*key, "x", F.col("x.left").alias("left")).join(confident_patterns(scan, params), "left", "left_semi")
    span = F.struct(F.col("x.s").alias("s"), F.col("x.k").alias("k"), F.col("x.e").alias("e"), F.col("x.t").alias("t"))
    return hits.groupBy(*key).agg(F.collect_set(span).alias("added"))


def find(docs: DataFrame, params: BootstrapParams = BootstrapParams()) -> DataFrame:
    """doc_id, base and all spans of every row of ``docs``."""
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    scan = written(scanned(numbered, ["row", "doc_id"]), "pii_scan")
    added = written(added_spans(scan, ["row"], params), "pii_added")
    spans = F.concat("base", F.coalesce("added", S.none()))
    return scan.select("row", "doc_id", "base").join(added, "row", "left").select("doc_id", "base", spans.alias("spans"))


def mask(docs: DataFrame, params: BootstrapParams = BootstrapParams()) -> DataFrame:
    """``docs``, all columns, with personal data in ``text`` replaced by ``[KIND]``; null texts stay null."""
    same = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    scan = written(scanned(docs.select("text", same.alias("same")), ["same"]), "pii_scan")
    added = written(added_spans(scan, ["same"], params), "pii_added")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    joined = docs.select(row, "text", same.alias("same")).join(added, "same", "left")
    spans = F.concat(let(F.coalesce("text", F.lit("")), base_spans), F.coalesce("added", S.none()))
    clean = F.when(F.col("text").isNotNull(), let(spans, lambda s: S.masked(F.col("text"), s, KINDS))).alias("text")
    out = joined.select("row", clean)
    return out.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))
