"""The Merkle manifest and the vector codes against plain versions, and their odd rows."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.llm import merkle
from slotwise.llm import vector_codes as V

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
CLASHES = [f"{i} AS `{c}`" for i, c in enumerate(("tree", "id", "hash", "other", "place", "n", "block", "at", "lv", "rows", "path", "a.b", "line"))]


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes: list[str], place: int, start: str) -> tuple[str, list[str], str]:
    """(root, siblings of ``place``, root from ``start`` at its place)."""
    proof = []
    while len(nodes) > 1:
        lo = place // 3 * 3
        run = nodes[lo : lo + 3]
        proof += run[: place - lo] + run[place - lo + 1 :]
        start = h(*run[: place - lo], start, *run[place - lo + 1 :])
        nodes, place = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)], place // 3
    return nodes[0], proof, start


def plain_manifest(rows):
    by: dict = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(by[s], key=lambda x: x[:3]) for s in sources}
    subroots = [climb([x[2] for x in leaves[s]], 0, "")[0] for s in sources]
    out = []
    for at, s in enumerate(sources):
        for place, (_, _, leaf, r) in enumerate(leaves[s]):
            start = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                start = plain_leaf((*r[:4], r[4].replace("\n", "")))
            subroot, low, folded = climb([x[2] for x in leaves[s]], place, start)
            root, high, folded = climb(subroots, at, folded)
            out.append((r[0], leaf, subroot, root, h(*low, *high), folded, folded == root))
    return sorted(out, key=str)


def manifest(docs):
    got = merkle.manifest(docs, F.replace(F.col("text"), F.lit("\n"), F.lit("")), F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return got, sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in got.collect()), key=str)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3, None: 1}, {"a": 1100, "b": 244, None: 243, "é": 82, "": 2, "z": 1}, {f"s{i}": 1 + i % 4 for i in range(300)}])
def test_manifest_against_a_plain_one(spark, sizes):
    rows, at = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append(((at * 7919) % 100_003, s, ("en", None)[at % 2], None if at % 5 == 0 else at, (None, "", "a\nb", "x" * 50 + "\n", "no line é😀")[at % 5]))
            at += 1
    _, got = manifest(spark.createDataFrame(rows, DOCS).repartition(5))
    assert got == plain_manifest(rows)


def test_manifest_of_odd_rows(spark):
    rows = [(1, "a", None, None, "x\ny")] * 5 + [(None, "a", "en", 3, "p\nq")] * 2 + [(1, "a", None, None, None), (2, None, None, None, ""), (1, None, "de", 1, "z" * 400_000 + "\n")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", *CLASHES)
    table, got = manifest(docs)
    assert got == plain_manifest(rows)
    assert {r["verified"] for r in table.where("doc_id IS NULL").collect()} == {True}
    assert manifest(docs.limit(0))[1] == []


def test_proofs_fold_to_the_root(spark):
    rows = [(i, "a" if i % 3 else "b", "en", i, f"text {i}\n") for i in range(700)]
    table, _ = manifest(spark.createDataFrame(rows, DOCS))
    for r in table.limit(40).collect():
        node = r["leaf"]
        for s in r["proof"]:
            node = h(s["l"], node, s["r"])
        assert node == r["root"] and r["proof_sha256"] == h(*(s["l"] + s["r"] for s in r["proof"]))


# ---------------------------------------------------------------- vector codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    width = parts * -(-max(len(r[1]) for r in kept) // parts)
    q = [[math.floor(256 * x) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    size = width // parts
    cut = [[v[i * size : (i + 1) * size] for i in range(parts)] for v in q]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            met: dict = {}
            for v in cut:
                met.setdefault(near(v[p], books[p])[1], []).append(v[p])
            for j, vs in met.items():
                books[p][j] = [sum(c) // len(vs) for c in zip(*vs)]
    last = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in row) for row in last]
    total: dict = {}
    for r, e in zip(kept, errors):
        total[r[2]] = total.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{j:02x}" for _, j in row), e, total[r[2]], digest) for r, row, e in zip(kept, last, errors)), key=str)


def codes(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS q", "2 AS near", "3 AS code", "4 AS `of`", "5 AS `a.b`")
    return sorted((tuple(r) for r in V.encode(df.repartition(3)).collect()), key=str)


def test_codes_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    vector = lambda n=64: [float(np.float32(x)) for x in rng.normal(0, 1, n)]
    rows = [(i, vector(), (None, 1, 2)[i % 3]) for i in range(150)]
    rows += [(7, rows[7][1], 1), (7, rows[7][1], 1), (3, vector(), None), (None, vector(), 1), (500, None, 1), (501, [], 1), (502, [1.0, None], 2)]
    rows += [(503, [float("nan")] * 64, 1), (504, [float("inf")] + [0.0] * 63, 1), (505, vector(40), 9), (506, [0.0] * 64, 9)]
    assert codes(spark, rows) == plain_codes(rows)


def test_few_equal_and_no_vectors(spark):
    few = [(i, [0.5] * 20, None) for i in range(5)] + [(9, [-0.25] * 20, 1)]
    assert codes(spark, few) == plain_codes(few)
    assert codes(spark, [(1, None, 1)]) == []


def test_components_beyond_the_range_are_cut(spark):
    got = codes(spark, [(1, [1e30] * 16, 1), (2, [-1e30] * 16, 1), (3, [0.0] * 16, 2)])
    assert [r[:3] for r in got] == [(i, f"{i - 1:02x}" * 16, 0) for i in (1, 2, 3)]


def test_pivots_spare_most_evaluations():
    rng = np.random.default_rng(1)
    parts = rng.integers(-256, 256, (4000, 4))
    entries = parts[:64]
    pivots = V.far_pivots(entries, 3)
    gaps = ((parts[:, None] - pivots[None]) ** 2).sum(2)
    which, best, evaluated = V.nearest(parts, gaps, entries, pivots)
    every = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert (which == every.argmin(1)).all() and (best == every.min(1)).all()
    assert evaluated < 0.2 * every.size
    _, best, with_one = V.nearest(parts, gaps[:, :1], entries, pivots[:1])
    assert (best == every.min(1)).all() and evaluated < with_one < every.size
