"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import os
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from slotwise.llm import (  # noqa: E402
    bpe_reuse, ngram_join, packing, pii, quality_rules, secret_scan, substring_dedup, token_files, topk, toxicity,
)

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PASSAGE = " ".join(f"w{i}" for i in range(40))
#: Repeated rows, null and empty texts, a null id, white space of all kinds, a
#: word longer than a hashing block and columns named like internal ones.
ROWS = [
    (1, PASSAGE + " mail a.b@c.de or +49 (30) 1234567 now", "en"), (1, PASSAGE + " mail a.b@c.de or +49 (30) 1234567 now", "en"),
    (2, "x " + PASSAGE + " password = hunter2hunter2", None), (3, None, "en"), (4, "", None), (None, PASSAGE, "en"),
    (5, " \t\n\x0b\x0c\r ", "de"), (6, "one two", "de"), (7, "One  two", "de"), (8, "z" * 1_200_000 + " end", "en"), (9, "a b c d é ß 😀", "fr"),
]
CLASHES = "'k' AS k, 1 AS row, 2 AS h, 3 AS n, 4 AS spans, 5 AS base, 6 AS kept, 7 AS m, 8 AS `a.b`, CAST(NULL AS STRING) AS extra, 9 AS n_words, 1 AS stratum, 2 AS same, 3 AS _nth"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string").selectExpr("*", *CLASHES.split(", "))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def ids(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.select("doc_id").collect())


EVERY = sorted((d is None, d or 0) for d, _, _ in ROWS)


def test_spans_of_odd_rows(docs):
    for module, find in ((pii, brute.pii_spans), (secret_scan, brute.secret_spans)):
        got = module.find(docs)
        assert ids(got) == EVERY
        texts: dict = {}
        for d, t, _ in ROWS:
            texts[d] = t or ""
        for r in got.collect():
            text = texts[r["doc_id"]]
            # The plain patterns take the square of a long word's length; that row has no match.
            assert sorted((b["s"], b["k"], b["e"]) for b in r["base"]) == (find(text) if len(text) < 10_000 else [])


def test_mask_replaces_and_keeps_columns(docs):
    got = pii.mask(docs)
    assert got.columns == docs.columns and got.count() == len(ROWS)
    one = got.where("doc_id = 1").first()
    assert one["text"] == PASSAGE + " mail [EMAIL] or [PHONE] now"
    assert got.where("doc_id = 3").first()["text"] is None and got.where("doc_id = 4").first()["text"] == ""


def test_many_matches_in_one_text(spark):
    text = "ünï " + " ".join(f"u{i}@host.example" for i in range(700))
    r = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert sorted((b["s"], b["k"], b["e"]) for b in r["base"]) == brute.pii_spans(text)


@pytest.mark.parametrize("text", [
    "a@b.c_d@e.f x@y a.b@c..d 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 +1 234 567 8901 ++49301234567 (",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa@ 12345678901234567890123 .@. %a@a.a-", "+1((((((((((2 +123456789 0 +12345678901234567 a@b.c@d.e",
])
def test_pii_corner_matches(spark, text):
    r = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert sorted((b["s"], b["k"], b["e"]) for b in r["base"]) == brute.pii_spans(text)


@pytest.mark.parametrize("text", [
    "secret:token:abcdefghij secret==abcdefgh API_KEY = 'aB/+=.-_12345' passwd:short", "AKIAAKIA1234567890 AKIA AKIAZ0123456789AB é AKIAabc",
    "0123456789abcdef0123456789abcdefX 0123456789abcdef0123456789abcde", "token=token=token= tOkEn : \"xxxxxxxx\"",
])
def test_secret_corner_matches(spark, text):
    r = secret_scan.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert sorted((b["s"], b["k"], b["e"]) for b in r["base"]) == brute.secret_spans(text)


def test_markov_ratio_tells_random_strings(spark):
    rng = np.random.default_rng(1)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 24)) for _ in range(300)]
    plain = ["_".join(rng.choice(["user", "name", "value", "index", "count", "total", "error", "file"], 4)) for _ in range(300)]
    samples = spark.createDataFrame([(t, True) for t in noise[:200]] + [(t, False) for t in plain[:200]] + [(None, True)], "token string, random boolean")
    model = secret_scan.train(samples)
    test = spark.createDataFrame([(t, True) for t in noise[200:]] + [(t, False) for t in plain[200:]], "token string, random boolean")
    scored = test.withColumn("hit", secret_scan.ratio(F.col("token"), model) > 12).collect()
    assert sum(r["hit"] == r["random"] for r in scored) >= 0.97 * len(scored)


def test_bootstrap_finds_unseen_identifiers(spark):
    rows = [(i, f"filler words here write to u{i}@host.example soon") for i in range(60)] + [(100, "please write to room 77b"), (101, "we write to #agent9x today")]
    got = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), pii.BootstrapParams(confidence=0.8)).collect()}
    added = [x["t"] for x in got[101]["spans"] if x["k"] == 4]
    assert added == ["#agent9x"] and not got[100]["base"]


def test_quality_of_odd_rows(docs, labels):
    got = quality_rules.judge(docs, labels)
    assert ids(got) == EVERY and not any(r["kept"] for r in got.collect() if r["doc_id"] in (3, 4, 5))
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns


def test_binomial_tail_is_exact(spark):
    from math import comb

    for k, n in ((0, 50), (2, 400), (7, 900), (9, 1000), (500, 1000)):
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), 0.01)).first()[0]
        want = sum(comb(n, j) * 0.01**j * 0.99 ** (n - j) for j in range(k + 1)) if k <= n * 0.01 else 1.0
        assert abs(got - want) < 1e-9


def test_cutoffs_hold_the_limit(spark):
    rng = np.random.default_rng(3)
    rows = [("en", bool(g), float(x)) for g in (0, 1) for x in (rng.normal(0.02, 0.004, 9000) if g else rng.normal(0.2, 0.05, 3000))]
    frame = spark.createDataFrame(rows, "stratum string, good boolean, x double")
    holdout = frame.select("stratum", "good", F.struct(*(F.col("x").alias(r) for r in quality_rules.RULES)).alias("m"))
    limits = quality_rules.cutoffs(holdout).collect()
    assert len(limits) == 1 and limits[0]["symbol_share"] == 0.05
    lost = sum(g and x > 0.05 for _, g, x in rows) / 9000
    assert lost <= quality_rules.RiskParams().rule_alpha


def test_token_files_of_odd_rows(spark, docs, tmp_path):
    folder = str(tmp_path / "files")
    shards = token_files.write(docs, WORDS, folder, length=16)
    got = token_files.read(spark, folder, shards)
    assert ids(got) == EVERY
    shard = shards.where("n_docs > 0").first()["shard"]
    reader = token_files.ShardReader(folder, shard)
    values, mask = reader.sequence(0)
    assert len(values) == len(mask) == 16
    total = sum(r["n_ids"] for r in shards.collect())
    seen = 0
    for r in shards.collect():
        reader = token_files.ShardReader(folder, r["shard"])
        n = -(-r["n_ids"] // 16)
        seen += sum(int(reader.sequence(i)[1].sum()) for i in range(n))
    assert seen == total == sum(r["n_tokens"] for r in got.collect())


def test_packing_and_bpe_of_odd_rows(docs):
    packed = packing.pack(docs, WORDS, rounds=20)
    assert sorted(set(ids(packed))) == sorted(set(EVERY))
    got = bpe_reuse.encode(docs, BYTES, mean=64)
    assert ids(got) == EVERY
    assert {r["n_tokens"] for r in got.where("doc_id IN (3, 4)").collect()} == {0}


def test_joins_are_repaired_exactly():
    import random

    fast = bpe_reuse.Codec(BYTES, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = bpe_reuse.Codec(BYTES)
    pick = random.Random(5)
    for _ in range(400):
        text = "".join(pick.choice("aab  \n's're12é😀,.!<|") if pick.random() < 0.95 else "<|endoftext|>" for _ in range(pick.randint(0, 300)))
        parts = bpe_reuse.chunks(text.encode(), 16)
        assert b"".join(parts) == text.encode()
        want = library.encode(text)
        assert np.array_equal(np.array(bpe_reuse.join_all(fast, [fast.encode(p.decode()).tolist() for p in parts]), dtype=np.uint32), want)
        assert fast.decode(want) == library.library.decode(want.tolist(), skip_special_tokens=False)


def test_packing_plan_reaches_the_bound():
    from collections import Counter

    from slotwise.llm.packing_plan import best_fit, plan

    # 0.4 + 0.3 + 0.3 fills a sequence; best fit pairs the 0.4s and wastes a fifth.
    hist = {400: 300, 300: 600}
    assert sum(best_fit(Counter(hist), 1000).values()) > 300
    got = plan(hist, 1000, rounds=200)
    served = Counter()
    for config, n in got.items():
        assert sum(length * c for length, c in config) <= 1000
        for length, c in config:
            served[length] += c * n
    assert served == Counter(hist) and sum(got.values()) <= 305


def test_repeats_of_odd_rows(docs):
    got = substring_dedup.deduplicated(docs, 13)
    assert ids(got) == EVERY
    named = {r["doc_id"]: r for r in got.collect()}
    assert named[1]["n_removed"] == 0 and named[2]["n_removed"] == 40 and named[None]["n_removed"] == 0
    rows = substring_dedup.without_repeats(docs, 13)
    assert rows.columns == docs.columns and rows.where("doc_id = 2").first()["text"] == "x password = hunter2hunter2"


def test_repeats_against_brute_force(spark):
    rng = np.random.default_rng(9)
    base = [f"t{rng.integers(40)}" for _ in range(600)]
    rows = []
    for d in range(80):
        a = int(rng.integers(0, 500))
        rows.append((d, " ".join([f"u{rng.integers(10**6)}" for _ in range(rng.integers(0, 30))] + base[a : a + int(rng.integers(5, 90))] + ["same"] * int(rng.integers(0, 20)))))
    want = brute.without_repeats(rows, 13)
    got = substring_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 13, True).collect()
    for r in got:
        assert (r["text"], r["n_words"]) == (" ".join(want[r["doc_id"]][0]), want[r["doc_id"]][1])


def test_doubling_ends_at_the_longest_repeat(spark):
    rows = [(1, PASSAGE), (2, "y " + PASSAGE), (3, "nothing here")]
    got = {r["length"]: r["windows"] for r in substring_dedup.longest(spark.createDataFrame(rows, "doc_id long, text string"), 5, 1 << 15).collect()}
    assert got == {5: 36, 10: 31, 20: 21, 40: 1}


def test_join_of_odd_rows(docs):
    got = ngram_join.linked(docs)
    assert ids(got) == EVERY
    named = {r["doc_id"]: r for r in got.collect()}
    assert named[3]["n_shingles"] == named[4]["n_shingles"] == 0 and named[3]["component_id"] == 3
    assert named[7]["component_id"] == 6 and named[7]["n_shingles"] == 1 and named[None]["component_id"] is None
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns and ids(kept) == sorted([(False, d) for d in (1, 2, 3, 4, 5, 6, 8, 9)] + [(True, 0)])


@pytest.mark.parametrize("block", [4, 256])
def test_join_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = np.random.default_rng(11)
    rows, shared = [], [f"p{i}" for i in range(60)]
    for d in range(160):
        if d % 4 == 0 or not rows:
            words = [f"v{rng.integers(300)}" for _ in range(int(rng.integers(1, 80)))] + (shared if d % 8 == 0 else [])
        else:  # an edited copy of an earlier one
            words = rows[int(rng.integers(len(rows)))][1].split()
            for _ in range(int(rng.integers(0, 4))):
                words[int(rng.integers(len(words)))] = f"e{rng.integers(5)}"
        rows.append((d, " ".join(words)))
    want = brute.components(rows)
    got = ngram_join.linked(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), bits=1 << 15).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {d: len(brute.shingles(t)) for d, t in rows}


def test_bitmaps_use_all_their_bits_and_grow(spark):
    rows = [(d, " ".join(f"w{d // 2}x{i}" for i in range(300))) for d in range(40)]
    counts = ngram_join.held(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    tables = ngram_join._class_tables(counts, 1 << 15)
    places = np.flatnonzero(np.unpackbits(tables[0], bitorder="little"))
    near = 297 * 20 / ngram_join.PICK
    assert 0.8 * near < len(places) < 1.2 * near and {int(p) % 4 for p in places} == {0, 1, 2, 3}
    # About 3000 n-grams fit the least size; ten times as many do not.
    assert len(tables[0]) * 8 == 1 << 15 and ngram_join._bits(30_000, 1 << 15) == 1 << 18
    assert ngram_join._bits(0, 1 << 15) == 1 << 15 and ngram_join._bits(10**12, 1 << 15) == ngram_join.MOST_BITS


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.0, 0.0]), (1, None), (2, []), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [-0.001, 3.0]),
            (8, [float("inf"), 0.0]), (None, [1.0, 1.0]), (9, [1e300, 0.0]), (10, [1.0, 2.0, 3.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)), F.col("vec_id") % 50 == 0, 3).collect()
    first = [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0]
    assert first == [(9, 2**63 - 1), (5, 65536), (6, 65536)]
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 50] == [(0, 0), (0, 0), (5, 0)]


def test_threshold_stops_early_and_exactly():
    rng = np.random.default_rng(2)
    rows = np.floor(256 * rng.pareto(1.5, (3000, 3)))
    lists = topk.SortedLists(rows, np.arange(3000))
    for q in np.floor(256 * rng.random((20, 3))):
        scores, found = lists.top(q, -1, 5)
        everything = rows @ q
        best = np.lexsort((np.arange(3000), -everything))[:5]
        assert found.tolist() == best.tolist() and scores.tolist() == everything[best].tolist()


def test_toxicity_folding_and_exceptions(spark):
    lexicon = toxicity.Lexicon({" idiot ": 3.0, " scum": 2.0}, [" village idiot "], (0.0, 1.0, 0.0))
    assert [w for _, w in lexicon.hits(toxicity.fold("You 1D10T, sсumbag!"))] == [3.0, 2.0]  # a Cyrillic letter
    assert lexicon.hits(toxicity.fold("the village idiot")) == []
    assert lexicon.score("idiot " * 3) > lexicon.score("nothing") == lexicon.score(None) == lexicon.score("")
    rows = [(f"plain words number {i} " + ("awful thing" if i % 3 == 0 else "nice thing"), i % 3 == 0) for i in range(300)]
    learned = toxicity.learn(spark.createDataFrame(rows, "text string, toxic boolean"))
    assert learned.score("an awful day") > 0.3 > learned.score("a nice day")


def test_toxicity_of_odd_rows(docs, labels):
    lexicon = toxicity.learn(toxicity.sample(docs, labels, toxicity.LexiconParams()))
    got = toxicity.score(docs, lexicon)
    assert ids(got) == EVERY and all(r["score"] == 0.0 for r in got.collect())


def test_empty_tables(spark, docs, labels):
    none, no_labels = docs.where("false"), labels.where("false")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    results = [
        topk.top_k(vectors, F.col("vec_id") % 50 == 0), packing.pack(none, WORDS, rounds=5), toxicity.score(none, toxicity.learn(toxicity.sample(none, no_labels, toxicity.LexiconParams()))),
        substring_dedup.deduplicated(none), token_files.round_trip(none, WORDS), secret_scan.find(none), bpe_reuse.encode(none, BYTES), pii.find(none), pii.mask(none),
        quality_rules.judge(none, no_labels), quality_rules.keep_good(none, no_labels), ngram_join.linked(none), ngram_join.one_of_each(none), substring_dedup.without_repeats(none),
    ]
    assert [r.count() for r in results] == [0] * len(results)


@pytest.mark.parametrize("text,gone,want", [
    (b"a b  c\nd", [], b"a b  c\nd"), (b" a b  c\nd ", [1, 2], b" a\nd "), (b"a\nb c", [1], b"a\nc"), (b"a b", [0, 1], b""), (b"\ta b\n", [1], b"\ta\n"),
    (b"a b c d", [0, 2], b"b d"), (b"", [], b""), ("é ß\nx".encode(), [1], "é\nx".encode()),
])
def test_cut_words_leave_the_rest(text, gone, want):
    n = len(text.split())
    assert substring_dedup.without(text, np.isin(np.arange(n), gone)) == want


def test_near_copies_over_several_shares(spark, monkeypatch):
    """An open n-gram's documents dealt into many shares lose no link."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):  # a chain of edits: far ends are linked through others only
        rows.append((i, " ".join([f"e{j}" if j < i // 3 else w for j, w in enumerate(base)])))
    rows += [(200 + i, " ".join(rng.choice(base, 12)) + " common words that many hold") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.components(rows)
    for n in (2048, 7):
        monkeypatch.setattr(ngram_join, "CLOSE_ROWS", n)
        assert {r["doc_id"]: r["component_id"] for r in ngram_join.linked(docs).collect()} == want


A = " ".join(f"a{i}" for i in range(40))
C = " ".join(f"c{i}" for i in range(20))


@pytest.mark.parametrize("rows", [
    [(1, "A C"), (2, "x " + A), (2, C)],
    [(1, A + " " + C), (2, "x y z " + A), (2, C)],
    [(1, A), (2, "x " + A), (2, " ".join(A.split()[:13]) + " " + " ".join(f"y{i}" for i in range(60)))],
    [(2, A), (2, C), (3, C + " " + A), (1, "q " + C), (None, A)],
])
def test_repeats_where_one_id_has_several_texts(spark, rows):
    """Every row loses its own words only; windows of a smaller id decide, whichever text holds them."""
    words = lambda t: t.split()
    windows = lambda t: [tuple(words(t)[i : i + 13]) for i in range(len(words(t)) - 12)]
    want = []
    for d, t in rows:
        early = {w for e, u in rows if d is not None and e is not None and e < d for w in windows(u)}
        gone = {j for i, w in enumerate(windows(t)) if w in early for j in range(i, i + 13)}
        want.append((d, len(words(t)), len(gone)))
    got = substring_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted(map(str, ((r["doc_id"], r["n_words"], r["n_removed"]) for r in got.collect()))) == sorted(map(str, want))


def test_components_through_a_document_with_several_texts(spark):
    near = lambda t: t + " end"
    b = " ".join(f"b{i}" for i in range(40))
    rows = [(3, A), (5, near(A)), (5, near(b)), (9, b), (5, "alone " + C), (7, "other words here at all"), (6, C), (None, A), (8, None), (8, b)]
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in ngram_join.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ids = {d: c for (d, _), c in got.items()}
    assert {ids[d] for d in (3, 5, 9, 8, 6)} == {3} and ids[7] == 7 and ids[None] is None
    both = [(5, A), (5, b), (6, near(b)), (7, near(A)), (5, A)]  # two sets whose smallest document is one
    got = ngram_join.linked(spark.createDataFrame(both, "doc_id long, text string")).collect()
    assert len(got) == 5 and {r["component_id"] for r in got} == {5}
