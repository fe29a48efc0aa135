"""Every registered query against SQL, brute force or the tokenizers library."""

from __future__ import annotations

import hashlib
import os
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import brute  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402

from slotwise.llm import pii, secret_scan  # noqa: E402
from slotwise.llm.oracle import oracle_queries  # noqa: E402
from slotwise.llm.queries import queries  # noqa: E402

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def texts(spark, sf_dir) -> dict[int, str]:
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def rows(spark, name, sf_dir) -> dict[int, dict]:
    return {r["doc_id"]: r.asDict() for r in queries()[name](spark, sf_dir).collect()}


def tokenizer(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_against_sql(spark, name):
    got = compare(queries()[name](spark, SMALL), duck(SMALL), oracle_queries()[name])
    assert got["ok"], got


@pytest.mark.parametrize("name,kinds,find", [
    ("op6_secret_scan", secret_scan.KINDS, brute.secret_spans), ("op8_pii", pii.KINDS, brute.pii_spans),
])
def test_base_spans(spark, name, kinds, find):
    got = rows(spark, name, SMALL)
    for doc, text in texts(spark, SMALL).items():
        want = find(text)
        listed = brute.listed(want, kinds)
        assert got[doc]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(got[doc]["spans"].split(","))
        for k in range(max(k for k in range(len(kinds) - 1)) + 1):
            assert got[doc][f"n_{kinds[k]}"] == sum(s[1] == k for s in want)


def test_quality_counts(spark):
    got = rows(spark, "op9_quality_rules", SMALL)
    for doc, text in texts(spark, SMALL).items():
        r = got[doc]
        want = brute.quality_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        assert not (r["kept"] and r["base_failed"])


def test_packing(spark):
    import math

    t = tokenizer("word_bpe_49k.json")
    got = queries()["op2_best_fit_packing"](spark, TINY).collect()
    by_doc: dict[int, list] = {}
    bins: dict[int, list] = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    total = 0
    for doc, text in texts(spark, TINY).items():
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        total += len(ids)
        want = [(n, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for n, s in enumerate(range(0, len(ids), 2048))]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc]) == want
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(bins) <= math.ceil(total / 2048) + 1


def test_token_files(spark):
    t = tokenizer("word_bpe_49k.json")
    got, start = rows(spark, "op5_token_files", TINY), 0
    for doc, text in sorted(texts(spark, TINY).items()):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        assert got[doc] == {"doc_id": doc, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
        start += len(ids)


def test_bpe(spark):
    t = tokenizer("byte_bpe_50k.json")
    got = rows(spark, "op7_bpe_reuse", TINY)
    for doc, text in texts(spark, TINY).items():
        ids = t.encode(text, add_special_tokens=False).ids
        plain = t.decode(ids, skip_special_tokens=False)
        assert got[doc]["n_tokens"] == len(ids)
        assert got[doc]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[doc]["decoded_sha256"] == hashlib.sha256(plain.encode()).hexdigest()


def test_toxicity_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = rows(spark, "op3_toxicity", sf_dir)
    held = [(r["predicted"], labels[d]) for d, r in got.items() if r["held_out"] and d in labels]
    for d, r in list(got.items())[:500]:
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.3)
    caught = sum(p for p, t in held if t) / sum(t for _, t in held)
    false = sum(p for p, t in held if not t) / sum(not t for _, t in held)
    assert caught > 0.8 and false < 0.02
