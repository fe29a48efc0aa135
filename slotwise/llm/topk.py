"""Operator 1: exact top-k inner products by Fagin's threshold algorithm.

Vectors are dealt into blocks of about ``BLOCK`` rows and queries into blocks
of ``QUERIES``; each pair of blocks is one group of one task. Inside a block
every dimension has its list of rows sorted by value, read from the top where
the query's component is positive and from the bottom where it is negative. A
query walks all lists in step; rows met for the first time are scored in full,
and the walk ends when the best score an unmet row could have, the query's
product with the values just read, is below the k-th score so far. The blocks'
answers, k per query and block, are merged by a window over the query.

Components are quantised to floor(256 x). Scores are exact: in doubles while no
sum can pass 2^53, else in Python integers, cut to the range of a long.

Defined cases: vectors that are null, empty or hold a null or non-finite
component, and rows without vec_id, take no part; vectors are compared with
those of their own length only; a query has all rows but those of its own
vec_id as candidates; of several query rows with one vec_id the smallest vector
asks; repeated candidates are ranked one by one; fewer candidates than k are
all returned. Columns other than vec_id and embedding are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotwise.llm.common import ship

BLOCK = 4096
QUERIES = 512


class SortedLists:
    """Rows of one block with a sorted list per dimension."""

    def __init__(self, rows, ids):
        import numpy as np

        self.rows, self.ids = rows, ids
        self.rising = np.ascontiguousarray(np.argsort(rows, axis=0, kind="stable").T)

    def top(self, query, own, k: int, first: int = 16):
        """(scores, vec_ids) of the k best rows by score, then smaller id; ``own`` is left out."""
        import numpy as np

        n = len(self.ids)
        used = np.flatnonzero(query)
        allowed = self.ids != own
        scores, ids = np.zeros(0, self.rows.dtype), np.zeros(0, self.ids.dtype)
        seen, depth, step = np.zeros(n, bool), 0, first
        rising = query[used] > 0
        while depth < n:
            until = min(n, depth + step)
            if len(used):
                from_top = self.rising[used[rising], n - until : n - depth]
                from_bottom = self.rising[used[~rising], depth:until]
                met = np.concatenate([from_top.ravel(), from_bottom.ravel()])
            else:  # a zero query scores every row 0
                met, until = np.arange(n), n
            new = np.unique(met[~seen[met]])
            seen[new] = True
            new = new[allowed[new]]
            scores = np.concatenate([scores, self.rows[new] @ query])
            ids = np.concatenate([ids, self.ids[new]])
            best = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[best], ids[best]
            if until == n:
                break
            last = np.where(rising, self.rising[used, n - until], self.rising[used, until - 1])
            if len(ids) == k and scores[-1] > (query[used] * self.rows[last, used]).sum():
                break
            depth, step = until, step * 4
        return scores, ids


def _quantised(vectors):
    import numpy as np

    return np.floor(256.0 * np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))


def _long(x) -> int:
    return max(-(2**63), min(2**63 - 1, int(x)))


def valid(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & F.coalesce(finite, F.lit(False))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best other rows of ``vectors``."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), is_query.alias("asks")).where(
        F.col("vec_id").isNotNull() & valid(F.col("embedding"))
    )
    n, n_queries = rows.agg(F.count("*"), F.count_if("asks")).first()
    n_blocks, n_query_blocks = -(-n // BLOCK) or 1, -(-n_queries // QUERIES) or 1
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    dealt = lambda m, *by: F.pmod(F.xxhash64(*by), F.lit(m)).cast("int")
    dim = F.size("embedding").alias("dim")
    queries = (
        rows.where("asks").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
        .select("vec_id", "embedding", dim, dealt(n_query_blocks, "vec_id").alias("qb"), every(n_blocks).alias("vb"))
    )
    block = dealt(n_blocks, "vec_id", F.monotonically_increasing_id())
    candidates = rows.select("vec_id", "embedding", dim, block.alias("vb")).select("*", every(n_query_blocks).alias("qb"))

    def search(asked, held):
        import numpy as np
        import pandas as pd

        out = []
        if len(asked) and len(held):
            rows, asks = _quantised(held["embedding"]), _quantised(asked["embedding"])
            if np.abs(rows).max() * np.abs(asks).max() * rows.shape[1] >= 2.0**53:
                rows, asks = (np.array([[int(x) for x in r] for r in m], dtype=object) for m in (rows, asks))
            lists = SortedLists(rows, held["vec_id"].to_numpy())
            for own, query in zip(asked["vec_id"], asks, strict=True):
                for score, vec in zip(*lists.top(query, own, k), strict=True):
                    out.append((own, vec, _long(score)))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["dim", "qb", "vb"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
