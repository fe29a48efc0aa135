"""Operator 13: product codes of vectors; LAESA pivots spare most distances.

Components become integers floor(256 x). A vector is cut into ``parts`` equal
consecutive parts, and every part position has a codebook of ``entries``
integer vectors, at first that part of the rows with the smallest vec_ids.
Each round gives every part its nearest entry (squared Euclidean distance,
ties to the lower index) and moves every used entry to the floor of its parts'
mean; a last assignment makes the codes.

Pivots: a few entries of each first codebook, far from one another, stay fixed.
The distances of all parts to them are computed once and written with the
integers. In each round only entries are measured against the pivots: by the
triangle inequality |d(part, pivot) - d(entry, pivot)| is at most
d(part, entry). A part visits entries by rising bound and stops where the bound
passes its best exact distance, so the result is that of measuring all. Bounds
are lowered by more than their rounding error; distances are exact integers.

Spark does the rounds: tasks assign their rows and send a count and a sum per
part and entry, which are added up by key; the driver holds codebooks only
(``parts`` x ``entries`` vectors), never rows.

Defined cases: vectors that are null, empty or hold a null or non-finite
component are dropped. Rows without vec_id or label are kept; such vec_ids come
last among the first entries, null labels form one group, and equal vec_ids
are ordered by their vectors. Repeated rows all count. Fewer rows than
``entries`` make smaller codebooks, no rows an empty result. Vectors shorter
than the longest, or whose length ``parts`` does not divide, are continued with
zeros. Integers are cut to the range in which no sum of squares passes a long
(2^27 at 64 components), label errors to a long. Columns other than vec_id,
embedding and label are never read.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import ship, written
from slotwise.llm.topk import valid

ROWS = 8192  #: parts bounded and measured at a time


def far_pivots(entries, n: int):
    """``n`` of the entries: the first, then always the one farthest from those taken."""
    import numpy as np

    taken = [0]
    gap = ((entries - entries[0]) ** 2).sum(1)
    while len(taken) < min(n, len(entries)):
        taken.append(int(gap.argmax()))
        gap = np.minimum(gap, ((entries - entries[taken[-1]]) ** 2).sum(1))
    return entries[taken]


def nearest(parts, to_pivots, entries, pivots):
    """(index, squared distance) of each part's nearest entry, and the number of exact evaluations.

    ``to_pivots`` holds the parts' squared distances to ``pivots``.
    """
    import numpy as np

    n = len(parts)
    entry_gaps = np.sqrt(((entries[:, None] - pivots[None]) ** 2).sum(2).astype(np.float64))
    part_gaps = np.sqrt(to_pivots.astype(np.float64))
    which = np.zeros(n, np.int64)
    best = np.full(n, np.iinfo(np.int64).max)
    evaluated = 0
    for lo in range(0, n, ROWS):
        gaps = part_gaps[lo : lo + ROWS]
        bound = np.zeros((len(gaps), len(entries)))
        for p in range(len(pivots)):
            np.maximum(bound, np.abs(gaps[:, p, None] - entry_gaps[:, p]), out=bound)
        slack = 1e-9 * (gaps.max() + entry_gaps.max())
        bound = np.maximum(bound - slack, 0) ** 2
        open_ = np.arange(len(gaps))
        while len(open_):
            left = bound[open_]
            entry = left.argmin(1)
            go = left[np.arange(len(open_)), entry] <= best[lo + open_]
            open_, entry = open_[go], entry[go]
            distance = ((parts[lo + open_] - entries[entry]) ** 2).sum(1)
            evaluated += len(open_)
            bound[open_, entry] = np.inf
            at = lo + open_
            better = (distance < best[at]) | (distance == best[at]) & (entry < which[at])
            best[at[better]], which[at[better]] = distance[better], entry[better]
    return which, best, evaluated


def _matrix(column, width: int):
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _integers(vectors, width: int, most: int):
    """floor(256 x) of a list of vectors, continued with zeros to ``width``."""
    import numpy as np

    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = np.clip(np.floor(256.0 * np.asarray(v, np.float64)), -most, most)
    return out


def _split(rows, parts: int):
    return rows.reshape(len(rows), parts, -1)


def encode(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, n_pivots: int = 3) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 per kept vector."""
    import numpy as np

    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    rows = rows.where(valid(F.col("embedding")))
    label = rows.schema["label"].dataType.simpleString()
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    if not longest:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = parts * -(-longest // parts)
    most = math.isqrt(2**62 // width) // 2
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    books = _split(_integers([r["embedding"] for r in first], width, most), parts).transpose(1, 0, 2).copy()
    pivots = [far_pivots(book, n_pivots) for book in books]
    n_near = sum(len(p) for p in pivots)

    def prepare(batches):
        import pyarrow as pa

        for b in batches:
            q = _integers(b.column("embedding").to_numpy(zero_copy_only=False), width, most)
            cut = _split(q, parts)
            near = np.concatenate([((cut[:, i, None] - pivots[i][None]) ** 2).sum(2) for i in range(parts)], axis=1)
            listed = lambda m, t: pa.ListArray.from_arrays(
                np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), pa.array(m.ravel(), t))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), listed(q, pa.int32()), listed(near, pa.int64())], ["vec_id", "label", "q", "near"])

    table = written(rows.mapInArrow(prepare, f"vec_id long, label {label}, q array<int>, near array<long>"), "parts")

    def assigned(batch, books):
        """Index and distance of every part of a batch, and its integers."""
        cut = _split(_matrix(batch.column("q"), width), parts)
        near, at = _matrix(batch.column("near"), n_near), 0
        which, best = np.zeros(cut.shape[:2], np.int64), np.zeros(cut.shape[:2], np.int64)
        for i in range(parts):
            which[:, i], best[:, i], _ = nearest(cut[:, i], near[:, at : at + len(pivots[i])], books[i], pivots[i])
            at += len(pivots[i])
        return cut, which, best

    size = width // parts
    for _ in range(rounds):

        def added(batches, books=books):
            import pyarrow as pa

            total = np.zeros((parts, books.shape[1], size + 1), np.int64)
            for b in batches:
                cut, which, _ = assigned(b, books)
                for i in range(parts):
                    np.add.at(total[i, :, 0], which[:, i], 1)
                    np.add.at(total[i, :, 1:], which[:, i], cut[:, i])
            part, entry = np.nonzero(total[:, :, 0])
            if len(part):
                sums = pa.array(list(total[part, entry]), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), sums], ["part", "entry", "sums"])

        sums = table.mapInArrow(added, "part int, entry int, sums array<long>").groupBy("part", "entry")
        moved = sums.agg(F.array(*(F.sum(F.col("sums")[j]) for j in range(size + 1))).alias("sums"))
        books = books.copy()
        for r in moved.collect():
            n, *total = r["sums"]
            books[r["part"], r["entry"]] = [t // n for t in total]

    def codes(batches):
        import pyarrow as pa

        for b in batches:
            _, which, best = assigned(b, books)
            text = [bytes(w).hex() for w in which.astype(np.uint8)] if books.shape[1] <= 256 else ["".join(f"{x:04x}" for x in w) for w in which]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(text, pa.string()), pa.array(best.sum(1))], ["vec_id", "label", "code", "error"])

    coded = written(table.mapInArrow(codes, f"vec_id long, label {label}, code string, error long"), "codes")
    cut_long = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    per_label = coded.groupBy(F.col("label").alias("of")).agg(cut_long.alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
