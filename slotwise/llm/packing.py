"""Operator 2: pack documents into as few token sequences as it can.

Documents become ids (with an end id) in tasks; those longer than a sequence
are cut into full pieces and a rest. Only the histogram of piece lengths, at
most ``capacity`` numbers, reaches the driver, where
:mod:`slotwise.llm.packing_plan` decides how many sequences of which
configuration there are. Pieces of one length are interchangeable: each gets
its number among them, and the plan's table of places, whose size depends on
the capacity and not on the data, turns that number into sequence and offset.

A length that a third of all pieces have is numbered in ``SALTS`` parts whose
sizes are added up first, so no task holds a whole length.

Defined cases: a null or empty text is the end id alone; a null doc_id and
repeated rows are packed like any others; an empty table gives no rows. Columns
other than doc_id and text are never read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotwise.llm.common import ship, written
from slotwise.llm.packing_plan import plan

SALTS = 256


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        from slotwise.llm.tokens import encoder

        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            rows = []
            for doc, ids in zip(batch["doc_id"], encoder(tokenizer).encode(batch["text"]), strict=True):
                ids = np.concatenate([ids, end])
                for n, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc, n, start, len(part), zlib.crc32(part.tobytes())))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = pd.array([None if pd.isna(d) else int(d) for d in out["doc_id"]], dtype="Int64")
            yield out

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def _places(spark, configs: Counter) -> DataFrame:
    """Where the n-th piece of a length goes.

    length, first (number of its first piece), copies, sequence (id of the
    configuration's first), at (offset of the first copy). A configuration's
    row for a length takes the next ``copies * sequences`` pieces.
    """
    taken: Counter = Counter()
    rows, sequence = [], 0
    for config, n in configs.items():
        at = 0
        for length, copies in config:
            rows.append((length, taken[length], copies, n, sequence, at))
            taken[length] += copies * n
            at += copies * length
        sequence += n
    return spark.createDataFrame(rows, "length long, first long, copies long, sequences long, sequence long, at long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, rounds: int = 400) -> DataFrame:
    """Pieces with the sequence and the offset they are placed at."""
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, capacity, end_id), "pieces")
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    sizes = cut.groupBy("length", "salt").agg(F.count("*").alias("n"))
    hist = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    before = F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    order = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = cut.withColumn("nth", F.row_number().over(order) - 1).join(offsets, ["length", "salt"])
    numbered = numbered.withColumn("nth", F.col("nth") + F.col("before")).drop("before", "salt")
    # Per length the ranges of numbers, in order: a search replaces a range join.
    places = _places(spark, plan(hist, capacity, rounds))
    by_length = places.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("first", "copies", "sequences", "sequence", "at"))).alias("ranges"))
    last = F.element_at(F.filter("ranges", lambda r: r["first"] <= F.col("nth")), -1)
    placed = numbered.join(F.broadcast(by_length), "length").withColumn("p", last)
    k = F.col("nth") - F.col("p.first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("p.sequence") + F.floor(k / F.col("p.copies"))).cast("long").alias("sequence_id"),
        (F.col("p.at") + (k % F.col("p.copies")) * F.col("length")).cast("long").alias("offset"),
    )
