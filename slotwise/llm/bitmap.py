"""A bounded bitmap of 64-bit hashes, built by Spark and broadcast.

It answers "may be there" for every hash that is, and for some that are not:
a filter before an exact step, of a size that does not depend on the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of column ``h`` (long); ``bits`` is a power of two, 32768 at least."""
    place = f"(h & {bits - 1}L) + 1"
    rows = hashes.groupBy(F.expr(f"bitmap_bucket_number({place})").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({place}))").alias("bitmap")
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.toLocalIterator():  # at most bits / 32768 rows of 4 KB
        part = np.frombuffer(r["bitmap"], np.uint8)
        at = (r["bucket"] - 1) * 4096
        out[at : at + len(part)] = part
    return out


def holds(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash (uint64) may be there."""
    place = hashes & np.uint64(len(table) * 8 - 1)
    return (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
