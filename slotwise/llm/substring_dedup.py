"""Operator 4: repeated passages, found by windows of doubling length.

A window of ``size`` words is repeated if its words also start in a document
of smaller doc_id; every word it covers goes. Levels double the length:

1. Half-length windows. Of the half windows inside a full one the smallest
   hash stands for it, so equal full windows name equal half windows and about
   a quarter of all places are looked at. Half windows that two documents name
   survive. They are passed on as a bitmap of bounded size, which may let
   through a few others but misses none.
2. Full windows, at places whose half window survived. A task keeps the
   smallest document of each window it meets and marks the others itself, so
   a window that a third of all documents hold costs one row per slice of text. The
   smallest document over all tasks decides the rest.

:func:`longest` goes on doubling, with the surviving windows of one level as
halves of the next, until none survives.

Texts of documents without a surviving half window are finished where they are
read; only the others are shuffled, to meet the marks of their doc_id. Windows are compared by 64 bits of hash.

Defined cases: a null or empty text has no words; a row with a null doc_id
keeps its words and counts for nobody; rows of one doc_id are one document as
to "smaller" and each keep their row; texts shorter than a window keep all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import LongType, StructField, StructType

from slotwise.llm import bitmap
from slotwise.llm.common import ship, written
from slotwise.llm.hashing import sliding_min, whole, window_hashes, word_hashes

FILTER_BITS = 1 << 27
SEVERAL_BITS = 1 << 20  #: of the doc_ids that have several texts
MOST_BYTES = 1 << 22  #: text handled at a time
MOST_HELD = 1 << 22  #: hashes a task gathers before it passes them on


def _runs(batch) -> Iterator:
    """Slices of an Arrow batch of about MOST_BYTES of text; a longer text is alone."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch["text"]), 0))
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > MOST_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)


def _words(batch) -> tuple:
    """(texts as bytes, word hashes, words per text, row and doc_id of every word's text)."""
    texts = [(t or "").encode() for t in batch["text"].to_pylist()]
    words, counts = word_hashes(texts)
    docs = batch["doc_id"].to_pylist()
    known = np.array([d is not None for d in docs], bool)
    ids = np.array([d if d is not None else 0 for d in docs], np.int64)
    row = np.repeat(np.arange(len(texts)), counts)
    return texts, words, counts, row, ids, known


def _half(size: int) -> int:
    return (size + 1) // 2


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _by_document(h: np.ndarray, doc: np.ndarray):
    """Smallest and largest document of each different hash as record batches of (h, doc)."""
    import pyarrow as pa

    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    lo, hi = (np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)) if len(h) else (doc, doc)
    h, more = h[first], lo < hi
    return pa.record_batch([pa.array(_signed(np.concatenate([h, h[more]]))), pa.array(np.concatenate([lo, hi[more]]))], names=["h", "doc"])


def _gathered(parts: Iterator) -> Iterator:
    """(hashes, documents) of many slices, grouped together up to MOST_HELD at a time."""
    held: list[tuple] = []
    for part in parts:
        held.append(part)
        if sum(len(h) for h, _ in held) > MOST_HELD:
            yield _by_document(*map(np.concatenate, zip(*held, strict=True)))
            held = []
    if held:
        yield _by_document(*map(np.concatenate, zip(*held, strict=True)))


def _shared(rows: DataFrame) -> DataFrame:
    """Hashes of (h, doc) that more than one document holds."""
    return rows.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("h")


def half_windows(docs: DataFrame, size: int) -> DataFrame:
    """Level 1: hashes of the half-length windows that name full windows of two documents or more."""
    half = _half(size)

    def named(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in _runs(batch):
                _, words, counts, row, ids, known = _words(part)
                names = sliding_min(window_hashes(words, half), size - half + 1)
                use = whole(counts, size) & known[row]
                names, row = names[use], row[use]
                new = np.concatenate([[True], (names[1:] != names[:-1]) | (row[1:] != row[:-1])]) if len(row) else use[:0]
                yield names[new], ids[row[new]]

    look = lambda batches: _gathered(named(batches))
    return _shared(docs.select("doc_id", "text").mapInArrow(look, "h long, doc long"))


def without(text: bytes, gone: np.ndarray) -> bytes:
    """``text`` without the words marked in ``gone``, all else as it is.

    Of the white space on both sides of a run of removed words one piece stays:
    the one after it if only that one holds a line end, else the one before it.
    After the last kept word only what ends the text stays.
    """
    ends = np.array([0, *(x for m in _WORD.finditer(text) for x in m.span()), len(text)])
    starts, stops = ends[1:-1:2], ends[2:-1:2]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    out, at = [], 0
    for first, after in edge.reshape(-1, 2).tolist():
        before = text[stops[first - 1] if first else 0 : starts[first]]
        follows = starts[after] if after < len(starts) else len(text)
        behind = text[stops[after - 1] : follows]
        out.append(text[at : starts[first] - len(before)])
        out.append(behind if after == len(starts) or b"\n" in behind and b"\n" not in before else before)
        at = follows
    return b"".join([*out, text[at:]])


def deduplicated(docs: DataFrame, size: int = 13, with_rows: bool = False, bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs``.

    ``with_rows`` adds ``text``, from which the removed words are cut and which
    is unchanged where none are, and ``extra``, a struct of the row's other columns under their names.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    ship(spark)
    others = [c for c in docs.columns if with_rows and c not in ("doc_id", "text")]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(F.lit(0), *(F.col(f"`{c}`") for c in others)).alias("extra"))
    table = spark.sparkContext.broadcast(bitmap.collect(half_windows(docs, size), bits))
    half = _half(size)
    # Marks go by document; where a doc_id has several texts, by the text's hash too.
    several = docs.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi")).where("doc_id IS NOT NULL AND lo <> hi")
    several = spark.sparkContext.broadcast(bitmap.collect(several.select(F.col("doc_id").alias("h")), SEVERAL_BITS))

    def keys_of(texts, ids):
        """Per row 0, or its text's hash where its doc_id may have another text."""
        hashed = bitmap.holds(several.value, ids.view(np.uint64))
        return np.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) if x else 0 for t, x in zip(texts, hashed, strict=True)], np.int64)

    def candidates(part):
        """The words of a slice, and the places of full windows whose half window survived."""
        texts, words, counts, row, ids, known = _words(part)
        use = whole(counts, size) & known[row]
        use &= bitmap.holds(table.value, sliding_min(window_hashes(words, half), size - half + 1))
        return texts, words, counts, row, ids, np.flatnonzero(use)

    def ask(batches: Iterator) -> Iterator:
        """Once per window and text of a slice: h, doc, key, first place, and whether a smaller document is here."""
        for batch in batches:
            for part in _runs(batch):
                texts, words, counts, row, ids, at = candidates(part)
                h, doc, key = window_hashes(words, size)[at], ids[row[at]], keys_of(texts, ids)[row[at]]
                place = at - (np.cumsum(counts) - counts)[row[at]]
                order = np.lexsort((place, key, doc, h))
                h, doc, key, place = h[order], doc[order], key[order], place[order]
                edge = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
                once = edge | np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]) if len(h) else edge
                first = doc[edge][np.cumsum(edge) - 1] if len(h) else doc
                waits = doc == first
                # Places of windows with a smaller document here need no answer.
                for some, settled in ((once & waits, False), (once & ~waits, True)):
                    n = int(some.sum())
                    hashes = pa.nulls(n, pa.int64()) if settled else pa.array(_signed(h[some]))
                    yield pa.record_batch([hashes, pa.array(doc[some]), pa.array(key[some]), pa.array(place[some].astype(np.int32))], names=["h", "doc", "key", "place"])

    asked = docs.select("doc_id", "text").mapInArrow(ask, "h long, doc long, key long, place int")
    # A window has one row per slice of its smallest document there.
    low = F.min("doc").over(W.partitionBy("h"))
    late = asked.where("h IS NOT NULL").withColumn("low", low).where("doc > low").select("doc", "key", "place")
    marks = late.unionByName(asked.where("h IS NULL").select("doc", "key", "place")).groupBy("doc", "key").agg(F.array_sort(F.collect_list("place")).alias("marks"))
    marks = written(marks.select(F.col("doc").alias("doc_id"), "key", "marks"), "repeat_marks")
    # A schema, not its text: the row's own columns may have any names.
    extra, text = docs.schema["extra"], docs.schema["text"]
    doc_id = docs.schema["doc_id"]
    final = StructType([doc_id, extra, text, *StructType.fromDDL("n_words long, n_removed long, kept_sha256 string").fields])

    def sort_out(mine: bool):
        """Rows that hold a candidate window, or the finished others."""

        def look(batches: Iterator) -> Iterator:
            for batch in batches:
                for part in _runs(batch):
                    texts, _, counts, row, ids, at = candidates(part)
                    has = np.zeros(len(texts), bool)
                    has[row[at]] = True
                    if mine:
                        yield part.append_column("key", pa.array(keys_of(texts, ids))).filter(pa.array(has))
                        continue
                    rest = np.flatnonzero(~has)
                    kept = [b" ".join(texts[i].split()) for i in rest]
                    same = part["text"].take(pa.array(rest)) if with_rows else pa.nulls(len(rest), pa.string())
                    columns = [same, pa.array(counts[rest]), pa.array(np.zeros(len(rest), np.int64)),
                               pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
                    taken = part.take(pa.array(rest))
                    yield pa.record_batch([taken["doc_id"], taken["extra"], *columns], names=["doc_id", "extra", "text", "n_words", "n_removed", "kept_sha256"])

        return look

    rest = docs.select("doc_id", "text", "extra").mapInArrow(sort_out(False), final)
    texts = docs.select("doc_id", "text", "extra").mapInArrow(sort_out(True), StructType([doc_id, text, extra, StructField("key", LongType())]))

    def finish(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in _runs(batch):
                texts, words, counts, row, _, _ = _words(part)
                full = _signed(window_hashes(words, size))
                inside = whole(counts, size)
                ends = np.cumsum(counts)
                out: dict[str, list] = {"text": [], "n_words": [], "n_removed": [], "kept_sha256": []}
                for i, (text, marked) in enumerate(zip(texts, part["marks"], strict=True)):
                    a, b = ends[i] - counts[i], ends[i]
                    starts = np.zeros(counts[i], np.int64)
                    if marked.is_valid:  # every place of the marked windows
                        starts |= np.isin(full[a:b], full[a + marked.values.to_numpy()]) & inside[a:b]
                    edge = np.zeros(counts[i] + size, np.int64)
                    edge[: counts[i]] += starts
                    edge[size:] -= starts
                    gone = np.cumsum(edge)[: counts[i]] > 0
                    kept = b" ".join(compress(text.split(), ~gone))
                    out["text"].append(part["text"][i].as_py() if with_rows and not gone.any() else without(text, gone).decode() if with_rows else None)
                    out["n_words"].append(int(counts[i]))
                    out["n_removed"].append(int(gone.sum()))
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                types = {"text": pa.string(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}
                yield pa.record_batch([part["doc_id"], part["extra"], *(pa.array(out[c], t) for c, t in types.items())], names=["doc_id", "extra", *types])

    done = texts.join(marks, ["doc_id", "key"], "left").select("doc_id", "extra", "text", "marks").mapInArrow(finish, final)
    every = rest.unionByName(done)
    return every.select("doc_id", "n_words", "n_removed", "kept_sha256", *(["text", "extra"] if with_rows else []))


def without_repeats(docs: DataFrame, size: int = 13, bits: int = FILTER_BITS) -> DataFrame:
    """``docs``, all columns, with repeated words cut from ``text``; other texts stay byte for byte."""
    got = deduplicated(docs, size, True, bits)
    return got.select(*(F.col(c) if c in ("doc_id", "text") else F.col(f"extra.`{c}`").alias(c) for c in docs.columns))


def longest(docs: DataFrame, size: int = 13, bits: int = FILTER_BITS) -> DataFrame:
    """length, windows: different windows that two documents hold, at every doubled length that has any."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    halves = spark.sparkContext.broadcast(bitmap.collect(half_windows(docs, size), bits))
    half, length, found = _half(size), size, []
    while True:
        def look(batches: Iterator, length=length, halves=halves, half=half) -> Iterator:
            for batch in batches:
                for part in _runs(batch):
                    _, words, counts, row, ids, known = _words(part)
                    parts = window_hashes(words, half)
                    use = whole(counts, length) & known[row]
                    if half * 2 == length and length > size:  # both halves must have survived
                        both = bitmap.holds(halves.value, parts)
                        use[: len(use) - half] &= both[: len(use) - half] & both[half:]
                    else:
                        use &= bitmap.holds(halves.value, sliding_min(parts, length - half + 1))
                    yield _by_document(window_hashes(words, length)[use], ids[row[use]])

        shared = written(_shared(docs.mapInArrow(look, "h long, doc long")), f"windows_{length}")
        n = shared.count()
        if not n:
            return spark.createDataFrame(found, "length int, windows long")
        found.append((length, n))
        halves, half, length = spark.sparkContext.broadcast(bitmap.collect(shared, bits)), length, 2 * length
