"""Operator 10: Jaccard join of n-gram sets over prefix trees.

A document's set holds its different word n-grams; two documents are linked if
their sets have a Jaccard similarity of ``percent`` / 100 or more. The result
is each document's component under links.

* Global order. Sets are ordered by one order of all n-grams, rare first: of
  the n-grams a hash picks (one in ``PICK``) the number of documents that hold
  them is counted, and their class (held once, a few times, often) comes
  first, then the hash. Two similar sets share an n-gram within their first
  n - ceil(percent n) + 1, so a document whose first n-grams are all held once
  is done: it has no partner. Most documents end here, in the task that reads
  them.
* Equal sets of the remaining documents are one set.
* Stars. Every shared n-gram among the first has a centre, the smallest
  document; each document is compared with its centres. A centre's documents
  are dealt into blocks of about ``BLOCK`` sets, and a block is joined by a
  prefix tree of its ordered sets (:mod:`slotwise.llm.set_trie`). Only links
  that connect are returned, so a group of copies costs a line per document.
* Rest. N-grams whose documents are still in different components are joined
  again, all pairs of blocks where a group is larger than one. Parity bitmaps of
  the sets, a bit for every other n-gram, bound the difference of two sets from
  below and rule out almost all pairs before any set is moved; what they leave
  is joined by prefix trees. No partner is dropped.

The classes travel as bitmaps that grow with the n-grams in them, up to
``MOST_BITS``. A bitmap may put an n-gram into a later class, for all documents
alike, so the order stays one; a fuller one lets more documents wait.
N-grams are 64-bit hashes.

Defined cases: a null or empty text, or one without words, has the empty set
and is linked with nothing; a row with a null doc_id counts for nobody and has
a null component; rows of one doc_id are linked with each other through it,
whatever their texts, and so are the components that its texts are in.
Columns other than doc_id and text are never read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotwise.llm import bitmap
from slotwise.llm.common import discard, ship, written
from slotwise.llm.components import components
from slotwise.llm.hashing import window_hashes, word_hashes
from slotwise.llm.substring_dedup import _runs

FILTER_BITS = 1 << 26  #: of a class's bitmap, at least
MOST_BITS = 1 << 30  #: at most: 128 MB
SLOTS = 8  #: bits per n-gram of the class, between the two
PICK = 2
CLASSES = (2, 16, 256)  #: documents from which on an n-gram is in the next class
BLOCK = 256
CLOSE_ROWS = 2048  #: sets in a share of an open n-gram's documents, two of which meet in one task
CLOSE_BYTES = 1 << 25  #: of parity bits in such a share; a set of n has n / 2 bytes at most

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The different n-grams of every text, as sorted hashes."""
    words, counts = word_hashes([(t or "").encode().translate(_LOWER) for t in texts])
    grams = window_hashes(words, n)
    ends = np.cumsum(counts)
    out = []
    for count, end in zip(counts.tolist(), ends.tolist(), strict=True):
        if count >= n:
            out.append(np.unique(grams[end - count : end - n + 1]))
        elif count:
            out.append(window_hashes(words[end - count : end], count)[:1])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def parity(grams: np.ndarray) -> bytes:
    """A bit per slot: whether an odd number of n-grams hash to it.

    Two sets' bits differ in at most as many slots as n-grams are in only one
    of them. Bits of a set of n fill 2 n slots or more, a power of two, and
    fold to half as many by exclusive or.
    """
    slots = max(256, 1 << int(2 * len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _first(n: int, percent: int) -> int:
    """How many first n-grams of a set of n any similar set must share one of."""
    return n - -(-percent * n // 100) + 1


def _picked(grams: np.ndarray) -> np.ndarray:
    """Whether each n-gram is counted: by its high bits, since bitmaps place it by the low ones."""
    return grams < np.uint64((1 << 64) // PICK)


def _bits(grams: int, least: int) -> int:
    """Bits of a bitmap that holds so many n-grams."""
    return max(least, min(MOST_BITS, 1 << (SLOTS * grams).bit_length()))


def _class_tables(counts: DataFrame, least: int) -> list[np.ndarray]:
    """Per class a bitmap of the n-grams in it or in a later one, as large as their number asks for."""
    sizes = counts.agg(*(F.count_if(F.col("n") >= c) for c in CLASSES)).first()
    return [bitmap.collect(counts.where(F.col("n") >= c).select("h"), _bits(size, least)) for c, size in zip(CLASSES, sizes, strict=True)]


def held(docs: DataFrame, n: int) -> DataFrame:
    """h, n: documents that hold each picked n-gram, for those that two or more hold."""
    import pyarrow as pa

    def look(batches: Iterator) -> Iterator:
        for batch in batches:  # a batch's picked n-grams are half as many as its words
            held = []
            for part in _runs(batch):
                known = part["doc_id"].is_valid().to_pylist()
                sets = [s for s, k in zip(shingle_sets(part["text"].to_pylist(), n), known, strict=True) if k]
                held += [s[_picked(s)] for s in sets]
            if held:
                h, count = np.unique(np.concatenate(held), return_counts=True)
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(count.astype(np.int32))], names=["h", "n"])

    return docs.mapInArrow(look, "h long, n int").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= CLASSES[0])


def linked(docs: DataFrame, n: int = 4, percent: int = 85, bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    import pyarrow as pa

    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = written(held(docs, n), "ngram_counts")
    tables = spark.sparkContext.broadcast(_class_tables(counts, bits))
    discard(counts)

    def look(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in _runs(batch):
                ids = part["doc_id"].to_pylist()
                sets = shingle_sets(part["text"].to_pylist(), n)
                sizes = np.array([len(s) for s in sets])
                grams = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
                picked = _picked(grams)
                level = sum(bitmap.holds(t, grams).astype(np.int8) for t in tables.value)
                # Picked ones by class, the others before the most frequent class.
                rank = np.where(picked, np.where(level == len(CLASSES), len(CLASSES) + 1, level), len(CLASSES)).astype(np.int8)
                order = np.lexsort((grams, rank, np.repeat(np.arange(len(sets)), sizes)))
                grams, rank = grams[order].view(np.int64), rank[order]
                ends, told = np.cumsum(sizes), set()
                rows: list[tuple] = []
                for i, size in enumerate(sizes.tolist()):
                    a = int(ends[i]) - size
                    to = a + _first(size, percent)
                    if not size or ids[i] is None or rank[to - 1] == 0:
                        rows.append((ids[i], size, None, None, None, None))
                        continue
                    k = _key(sets[i])
                    new = k not in told
                    told.add(k)
                    shared = grams[a:to][rank[a:to] > 0]
                    rows.append((ids[i], size, k, grams[a : ends[i]].tobytes() if new else None, parity(sets[i]) if new else None, shared.tolist() if new else None))
                types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
                columns = zip(*rows, strict=True) if rows else [[]] * 6
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n", "k", "grams", "parity", "first"])

    read = written(docs.mapInArrow(look, "doc_id long, n long, k binary, grams binary, parity binary, first array<long>"), "ngram_sets")
    sets = written(
        read.where("k IS NOT NULL").groupBy("k").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("grams").alias("grams"), F.max("parity").alias("parity"), F.max("first").alias("first")), "ngram_reps"
    )
    ids = written(read.select("doc_id", "n", "k"), "ngram_ids")
    discard(read)
    waiting = ids.where("k IS NOT NULL")
    sets, shared = _own_nodes(sets)
    links = _links(sets, percent)
    nodes = components(links)
    of_set = written(
        sets.select("k", "rep").join(nodes.select(F.col("u").alias("rep"), F.col("v").alias("low")), "rep", "left")
        .select("k", F.coalesce("low", "rep").alias("component_id")), "ngram_components",
    )
    discard(sets, nodes)
    done = ids.where("k IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    rows = done.unionByName(waiting.select("k", "doc_id", F.col("n").alias("n_shingles")).join(of_set, "k").select("doc_id", "n_shingles", "component_id"))
    return _through_documents(written(rows, "ngram_rows"), shared)


def _own_nodes(sets: DataFrame) -> tuple[DataFrame, bool]:
    """``sets`` with a node ``rep`` of their own each, and whether any needed one.

    A set's node is its smallest document. Of the sets of one document with
    several texts more than one may have it; these take a hash of the set.
    """
    twice = sets.groupBy("rep").count().where("count > 1").select(F.col("rep").alias("of"))
    if twice.isEmpty():
        return sets, False
    own = F.when(F.col("of").isNotNull(), F.xxhash64("k")).otherwise(F.col("rep")).alias("rep")
    named = sets.join(twice, F.col("rep") == F.col("of"), "left").select("k", own, *(c for c in sets.columns if c not in ("k", "rep")))
    return written(named, "ngram_own_nodes"), True


def _through_documents(rows: DataFrame, shared: bool) -> DataFrame:
    """``rows`` with the components joined that one document's texts are in, named by their smallest document."""
    several = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component_id").alias("u"), F.max("component_id").alias("v")).where("u <> v")
    if not shared and several.isEmpty():
        return rows
    met = several.select("doc_id", "u").join(rows, "doc_id").where("component_id <> u").select("u", F.col("component_id").alias("v"))
    joined = components(met)
    label = F.coalesce(F.col("v"), F.col("component_id")).alias("label")
    labelled = written(rows.join(joined, F.col("component_id") == F.col("u"), "left").select("doc_id", "n_shingles", label), "ngram_labels")
    low = labelled.groupBy(F.col("label").alias("of")).agg(F.min("doc_id").alias("component_id"))
    return labelled.join(low, F.col("label").eqNullSafe(F.col("of"))).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, n: int = 4, percent: int = 85, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component, one row each, and those without a doc_id."""
    kept = linked(docs, n, percent, bits).where("doc_id = component_id").select("doc_id").distinct()
    spare = "_nth"
    while spare in docs.columns:
        spare += "_"
    nth = F.row_number().over(W.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    named = docs.join(written(kept, "ngram_kept"), "doc_id", "left_semi").withColumn(spare, nth).where(F.col(spare) == 1).drop(spare)
    return named.unionByName(docs.where("doc_id IS NULL"))


def _joined(percent: int):
    """Links that connect the sets of one block: rows (rep, grams, part, component)."""

    def join(frame):
        import pandas as pd

        from slotwise.llm.set_trie import SetTrie

        frame = frame.drop_duplicates("rep").sort_values(["n", "rep"])
        trie, reps, out = SetTrie(percent), frame["rep"].tolist(), []
        known: dict[int, int] = {}
        for i, (grams, component) in enumerate(zip(frame["grams"], frame["component"], strict=True)):
            tokens = np.frombuffer(grams, np.int64)
            me = len(trie.size)
            trie.size.append(len(tokens))
            trie.parent.append(me)
            if component in known:
                trie.union(me, known[component])
            known.setdefault(component, me)
            for other in trie._finish(me, tokens, trie._probe(me, tokens)):
                out.append((reps[i], reps[other]))
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64")

    return join


def _close(percent: int):
    """Pairs of a block in different components whose parities do not rule a link out."""

    def pairs(frame):
        import pandas as pd

        frame = frame.drop_duplicates("rep")
        n, reps, component = (frame[c].to_numpy() for c in ("n", "rep", "component"))
        bits = [np.frombuffer(p, np.uint8) for p in frame["parity"]]
        least = min(map(len, bits))
        table = np.stack([np.bitwise_xor.reduce(b.reshape(-1, least), axis=0) for b in bits])
        out = []
        for i in range(len(reps)):
            differ = np.bitwise_count(table[i + 1 :] ^ table[i]).sum(axis=1, dtype=np.int64)
            both = n[i + 1 :] + n[i]
            fits = (100 + percent) * differ <= (100 - percent) * both
            fits &= 100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i])
            for j in np.flatnonzero(fits & (component[i + 1 :] != component[i])) + i + 1:
                out.append((min(reps[i], reps[j]), max(reps[i], reps[j])))
        return pd.DataFrame(out, columns=["centre", "rep"]).astype("int64")

    return pairs


def _star_links(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links found by joining each centre with the documents paired with it, block by block."""
    blocks = stars.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # Each block has the centre and its share of the centre's documents.
    sizes = written(blocks, "ngram_blocks")
    dealt = stars.join(sizes, "centre").where("rep <> centre").select(
        "centre", "rep", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")
    )
    heads = dealt.select("centre", "block").distinct().select("centre", F.col("centre").alias("rep"), "block")
    grouped = written(dealt.unionByName(heads), "ngram_blocked")
    joined = grouped.join(sets.select("rep", "n", "grams"), "rep").withColumn("component", F.col("rep"))
    links = written(joined.groupBy("centre", "block").applyInPandas(_joined(percent), "u long, v long"), "ngram_links")
    discard(grouped, sizes)
    return links


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Links u, v between representatives that connect all that are similar."""
    members = written(sets.select("rep", "n", F.explode("first").alias("h")), "ngram_members")
    centres = members.groupBy("h").agg(F.min(F.struct("rep", "n")).alias("c"), F.count("*").alias("m")).where("m > 1")
    centres = written(centres.select("h", F.col("c.rep").alias("centre"), F.col("c.n").alias("n_centre")), "ngram_centres")
    near = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)
    stars = members.join(centres, "h").where(near(F.col("n"), F.col("n_centre"))).select("centre", "rep").distinct()
    stars = written(stars, "ngram_stars")
    first = _star_links(stars, sets, percent)
    discard(centres, stars)
    nodes = components(first)
    labelled = written(
        members.join(nodes.select(F.col("u").alias("rep"), "v"), "rep", "left").select("rep", "n", "h", F.coalesce("v", "rep").alias("component")), "ngram_labelled"
    )
    discard(members, nodes)
    # Sizes of similar sets lie in one band of the ratio or in two neighbours,
    # so an n-gram's documents meet by pairs of neighbouring bands only.
    band = F.floor(F.log(F.col("n").cast("double")) / (math.log(100 / percent) + 1e-6)).cast("int")
    banded = labelled.select("rep", "n", "h", "component", F.explode(F.array(band, band + 1)).alias("band"))
    open_ = banded.groupBy("h", "band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("n")).where("lo <> hi")
    # Every row is copied once per share of its group, so shares are as large as a task's memory allows.
    shares = F.greatest(F.col("m") / CLOSE_ROWS, F.col("n") / (2 * CLOSE_BYTES))
    opened = written(open_.select("h", "band", F.ceil(shares).cast("int").alias("blocks")), "ngram_open")
    left = banded.drop("n").join(opened, ["h", "band"]).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # A pair of documents meets in the block of both their shares.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    left = left.select("rep", "component", "h", "band", "mine", other).select(
        "rep", "component", F.struct("h", "band", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b")).alias("block")
    )
    left = written(left, "ngram_left")
    # Many n-grams of a passage have the same documents: one block serves them all.
    sign = left.groupBy("block").agg(
        F.bit_xor(F.xxhash64("rep")).alias("x"), F.sum(F.xxhash64(F.lit(1), "rep") % 1_000_003).alias("y"), F.count("*").alias("m")
    )
    chosen = written(sign.groupBy("x", "y", "m").agg(F.min("block").alias("block")).select("block"), "ngram_chosen")
    close = left.join(chosen, "block").join(sets.select("rep", "n", "parity"), "rep").groupBy("block").applyInPandas(_close(percent), "centre long, rep long")
    close = written(close.distinct(), "ngram_close")
    discard(labelled, opened, left, chosen)
    second = _star_links(close, sets, percent)
    discard(close)
    return first.unionByName(second)
