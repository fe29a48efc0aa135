"""Operator 6: secrets by fixed patterns and by character Markov models.

The base patterns find assignments, access keys and long hex strings. Two
first-order character models are trained on samples labelled by them: the
values the base patterns found (random strings) and the long tokens of the
texts without a digit (ordinary identifiers). Every long token that no base
span touches, whatever its characters, is reported as ``random`` if its
log-likelihood ratio, random against ordinary, exceeds ``threshold``. A token
without a digit is a sample itself and would vouch for itself, so it is judged
by a model trained without the tokens of its half, by hash. Transition counts
cover all samples of all documents; a model has at most (alphabet + 1) squared
numbers, so all reach the driver and enter the scoring plan as one literal. Only DataFrame functions are used.

Defined cases: a null text counts as empty and has no spans; repeated rows are
each scanned; without samples of one label that model is uniform; columns other
than doc_id and text are never read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm import spans as S
from slotwise.llm.common import let, written

# The base patterns and the order of kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

#: Characters of the tokens that the models judge; any other counts as one more.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"


@dataclass(frozen=True)
class MarkovParams:
    threshold: float = 12.0  #: log-likelihood ratio a token must exceed
    smoothing: float = 0.5  #: added to every transition count


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds; ``text`` must not be null."""
    value = lambda t: F.length(F.regexp_extract(t, ASSIGN, 2)) >= 8
    return F.concat(
        S.guarded(text.rlike(r"(?i:password|passwd|secret|token|api_?key)"), S.matches(text, ASSIGN, 0, value)),
        S.guarded(F.contains(text, F.lit("AKIA")), S.matches(text, ACCESS, 1)),
        S.guarded(text.rlike(r"[0-9a-f]{32}"), S.matches(text, HEX, 2)),
    )


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id with base spans, all further long tokens, and the plain ones (without a digit) to train on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    long_tokens = S.matches(text, TOKEN, 3)
    got = docs.select("doc_id", let(text, base_spans).alias("base"), long_tokens.alias("tokens"))
    return got.select(
        "doc_id", "base",
        F.filter("tokens", lambda x: ~S.overlaps(x, F.col("base"))).alias("tokens"),
        F.transform(F.filter("tokens", lambda x: ~x["t"].rlike("[0-9]")), lambda x: x["t"]).alias("plain"),
    )


def _pairs(token: Column) -> Column:
    """A number for each character and the one before it (none: 0)."""
    width = len(ALPHABET) + 1
    places = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return let(places, lambda p: F.transform(p, lambda c, i: F.coalesce(F.get(p, i - 1), F.lit(0)) * width + c))


def train(samples: DataFrame, params: MarkovParams = MarkovParams()) -> list[float]:
    """Log-likelihood ratios of all transitions from samples (token, random boolean)."""
    width = len(ALPHABET) + 1
    counts = (
        samples.where("token IS NOT NULL AND random IS NOT NULL")
        .select("random", F.explode(_pairs(F.col("token"))).alias("pair"))
        .groupBy("random", "pair").count()
        .collect()  # at most two models of width squared transitions
    )
    seen = {(r["random"], r["pair"]): r["count"] for r in counts}
    out = []
    for before in range(width):
        rows = {m: [seen.get((m, before * width + c), 0) + params.smoothing for c in range(width)] for m in (True, False)}
        total = {m: sum(row) for m, row in rows.items()}
        out += [math.log(a / total[True]) - math.log(b / total[False]) for a, b in zip(rows[True], rows[False], strict=True)]
    return out


def ratio(token: Column, model: list[float], nth: Column | None = None) -> Column:
    """The token's log-likelihood ratio; ``nth`` picks one of several models that follow one another."""
    table = F.expr("array(" + ",".join(f"{x:.6f}D" for x in model) + ")")
    under = lambda start: F.aggregate(_pairs(token), F.lit(0.0), lambda a, p: a + F.get(table, start + p))
    return let((F.lit(0) if nth is None else nth) * (len(ALPHABET) + 1) ** 2, under)


def _half(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(2)).cast("int")


def find(docs: DataFrame, params: MarkovParams = MarkovParams()) -> DataFrame:
    """doc_id, base and all spans of every row of ``docs``."""
    got = written(scanned(docs), "secret_scan")
    secret = got.select(F.explode("base").alias("b")).select(
        F.when(F.col("b.k") == 0, F.regexp_extract("b.t", ASSIGN, 2)).otherwise(F.col("b.t")).alias("token"), F.lit(True).alias("random")
    )
    plain = got.select(F.explode("plain").alias("token"), F.lit(False).alias("random"))
    samples = secret.unionByName(plain)
    parts = [samples, *(samples.where(F.col("random") | (_half(F.col("token")) != k)) for k in (0, 1))]
    models = [x for part in parts for x in train(part, params)]
    nth = lambda t: F.when(t.rlike("[0-9]"), F.lit(0)).otherwise(1 + _half(t))
    added = F.filter("tokens", lambda x: ratio(x["t"], models, nth(x["t"])) > params.threshold)
    return got.select("doc_id", "base", F.concat("base", added).alias("spans"))
