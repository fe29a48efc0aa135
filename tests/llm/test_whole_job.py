"""Points of the review: each test fails on the code before its finding was settled."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import numpy as np  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from slotwise.llm import pii, quality_rules, secret_scan, toxicity  # noqa: E402


def test_near_copies_between_the_two_limits(spark):
    words = [f"w{i}" for i in range(95)]
    edited = [f"e{i}" if i in (20, 60) else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(f"v{i}" for i in range(95)))]
    share = lambda n: (lambda a, b: 100 * len(a & b) / len(a | b))(*(brute.shingles(t, n) for _, t in rows[:2]))
    assert share(5) >= 80 and share(4) < 85
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 3]


def test_contexts_reach_over_earlier_tokens_and_wide_gaps(spark):
    rows = [(i, f"id: {4000 + i} ssn: u{i}@host.example please write to v{i}@host.example") for i in range(60)]
    rows += [(100, "id: 4711 ssn: #agent9x"), (101, "please write" + " " * 300 + "to #agent8y"), (102, "4711 #agent7z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lefts = docs.where("doc_id IN (0, 102)").select("doc_id", F.explode(pii.tokens(F.col("text"))).alias("x")).select("doc_id", "x.t", "x.left").collect()
    assert {(d, t): left for d, t, left in lefts} == {
        (0, "4000"): "", (0, "u0@host.example"): "<ID> ssn: ", (0, "v0@host.example"): "write to ", (102, "4711"): "", (102, "#agent7z"): "",
    }
    got = {r["doc_id"]: [x["t"] for x in r["spans"] if x["k"] == 4] for r in pii.find(docs, pii.BootstrapParams(confidence=0.8)).collect()}
    assert (got[100], got[101], got[102]) == (["#agent9x"], ["#agent8y"], [])


def test_scores_do_not_depend_on_the_sample_size(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(4000):
        toxic = i % 10 == 0
        entry = rng.random() < (0.9 if toxic else 0.03)
        rows.append((i, f"plain words number {rng.integers(50)} " + ("awful" if entry else "nice") + " thing", int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scores = []
    for params in (toxicity.LexiconParams(), toxicity.LexiconParams(max_toxic=300, max_clean=600)):
        picked = toxicity.sample(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), params)
        scores.append(toxicity.learn(picked, params).score("an awful thing"))
    assert scores[0] > 0.5 and abs(scores[0] - scores[1]) < 0.1, scores


def test_only_certified_strata_get_cutoffs(spark):
    row = lambda stratum, good, x: (stratum, good, False, x)
    rows = [row("en", True, 0.02)] * 3000 + [row("en", False, 0.2)] * 3000 + [row("fi", True, 0.02)] * 50
    kind = "stratum string, good boolean, base_failed boolean, x double"

    def features(some):
        return spark.createDataFrame(some, kind).select("stratum", "good", F.struct("base_failed", *(F.col("x").alias(r) for r in quality_rules.RULES)).alias("m"))

    limits = quality_rules.cutoffs(features(rows))
    assert [r["stratum"] for r in limits.collect()] == ["en"]
    seen = features([row("en", True, 0.2), row("en", True, 0.02), row("fi", True, 0.3), row("xx", True, 0.3)])
    kept = quality_rules.judged(seen, limits).select("stratum", "m.symbol_share", "kept").collect()
    assert sorted(map(tuple, kept)) == [("en", 0.02, True), ("en", 0.2, False), ("fi", 0.3, True), ("xx", 0.3, True)]


def test_random_strings_without_digits_or_letters_are_scored(spark):
    rng = np.random.default_rng(6)
    any_of = lambda chars, n: "".join(rng.choice(list(chars), n))
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    parts = ["user", "name", "value", "index", "count", "total", "error", "file"]
    rows = [(i, "password = " + any_of(letters + digits, 32) + " and " + "_".join(rng.choice(parts, 4))) for i in range(300)]
    key, number = any_of(letters, 40), any_of(digits, 30)
    rows += [(900, f"see {key} now"), (901, f"see x,{number}, now"), (902, "see user_total_file_name now")]
    got = {r["doc_id"]: [x["t"] for x in r["spans"] if x["k"] == 3] for r in secret_scan.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[900], got[901], got[902]) == ([key], [number], [])
    assert not any(got[i] for i in range(300))


def test_exception_phrases_hold_across_signs():
    lexicon = toxicity.Lexicon({" bad ": 3.0}, [" not bad "])
    weight = lambda t: sum(w for _, w in lexicon.hits(toxicity.fold(t)))
    assert [weight(t) for t in ("not bad", "not\nbad", "not, bad", "not  bad", "NOT... bad!")] == [0] * 5
    assert [weight(t) for t in ("bad", "not so bad", "bad not")] == [3, 3, 3] and weight("bad, bad") == 6
