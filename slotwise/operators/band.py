"""Band join: equal keys and timestamps at most ``seconds`` apart.

Spark has no native range join, and an equi join on the site alone makes the
work grow with (rows per site)^2. Time is cut into ranges of ``SPAN`` bands per
key. A left row belongs to the range it lies in; a right row goes to its own
range and, as a halo row, across a boundary that is less than a band away, so
of ``SPAN`` rows two are copied. The join is an equi join on (keys, range) with
the exact band test as a residual; a left row has one range, so every pair
meets once and no de-duplication is needed.

Hot ranges are split on both sides. A range in which the two sides make more
than ``hot_pairs`` pairs becomes a grid of a x b groups: left rows take one of
``a`` rows of the grid by a hash and are copied along it, right rows one of
``b`` columns. a : b follows the sides' sizes, so no group tests more than
about ``hot_pairs`` pairs and the copies grow with the root of the pairs only.
No row is dropped. Rows go to the groups by an explicit number of partitions:
what a task makes follows from pairs, not from the input bytes by which
adaptive execution would merge small partitions. (Left rows that are equal in
every column share a hash and stay together.)

The ranges' sizes are two aggregates over keys and timestamps, reduced on the
map side. With ``materialize`` the few hot ranges are written once and Spark
broadcasts them if their bytes allow; nothing hot leaves the plain plan.
Without it they are part of the plan, joined as adaptive execution sees fit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LE, _RE = "__band_epoch_l", "__band_epoch_r"
_LB, _RB = "__band_bucket_l", "__band_bucket_r"
_ROW, _COL = "__band_row", "__band_col"
_ROWS, _COLS = "__band_rows", "__band_cols"
_INNER = (_LE, _RE, _LB, _RB, *(f"{c}_{side}" for c in (_ROW, _COL) for side in "lr"))

#: Width of a range in bands: a right row is copied with odds of 2 in SPAN; wider ranges test more pairs in vain.
SPAN = 4


def hot_ranges(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], hot_pairs: int) -> DataFrame:
    """(left keys, range, rows, cols): the grid of every range with more than ``hot_pairs`` pairs.

    ``left`` and ``right`` carry their ranges already.
    """
    nl = left.groupBy(*left_keys, _LB).agg(F.count(F.lit(1)).alias("nl"))
    nr = right.groupBy(*right_keys, _RB).agg(F.count(F.lit(1)).alias("nr"))
    on = [F.col(a) == F.col(b) for a, b in zip([*left_keys, _LB], [*right_keys, _RB], strict=True)]
    both = nl.join(nr, on).withColumn("parts", F.ceil(F.col("nl").cast("double") * F.col("nr") / hot_pairs)).where("parts > 1")
    rows = F.least(F.ceil(F.sqrt(F.col("parts") * F.col("nl") / F.col("nr"))), F.col("nl"))
    sized = both.withColumn("rows", rows).withColumn("cols", F.least(F.ceil(F.col("parts") / F.col("rows")), F.col("nr")))
    return sized.select(*left_keys, _LB, F.col("rows").cast("int").alias(_ROWS), F.col("cols").cast("int").alias(_COLS))


def _split(side: DataFrame, hot: DataFrame, keys: Sequence[str], end: str, own: str, other: str, n_own: str, n_other: str) -> DataFrame:
    """``side`` with its place in its range's grid: one ``own`` line by a hash, a copy in every ``other`` one."""
    columns = side.columns
    # Ranges are not part of the hash: a halo copy keeps the line of its row.
    line = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in columns if c not in _INNER)), F.col(n_own)).cast("int")
    met = side.join(hot, keys, "left")
    placed = met.select(
        *(F.col(f"`{c}`") for c in columns),
        F.coalesce(line, F.lit(0)).alias(f"{own}_{end}"),
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n_other), F.lit(1)) - 1)).alias(f"{other}_{end}"),
    )
    n = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(n, *keys, f"{_ROW}_{end}", f"{_COL}_{end}")


def band_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    seconds: int,
    condition: str | None = None,
    hot_pairs: int | None = None,
    materialize: Callable[[DataFrame, str], DataFrame] | None = None,
    spread: bool = False,
) -> DataFrame:
    """Inner join on ``left_keys == right_keys`` and ``|left_ts - right_ts| <= seconds``.

    Distances are in whole seconds (``unix_timestamp``), inclusive; rows with a
    null key or timestamp join nothing. Left and right column names must not
    collide (prefix them, e.g. ``a_``/``b_``). ``condition`` is an extra residual
    predicate (SQL text) over the joined columns. ``hot_pairs`` turns the split
    of hot ranges on; ``materialize`` (for example a stage store) writes their list.
    ``spread`` keeps the session's number of partitions without hot ranges too, for callers that keep every pair:
    merged by input bytes, the pairs come in little more tasks than there are cores, the last of which run alone.
    """
    if seconds <= 0:
        raise ValueError("seconds must be positive")
    left_keys, right_keys = list(left_keys), list(right_keys)
    s, width = int(seconds), SPAN * int(seconds)

    lt = left.selectExpr("*", f"unix_timestamp({left_ts}) AS {_LE}", f"floor(unix_timestamp({left_ts}) / {width}) AS {_LB}")
    at = f"unix_timestamp({right_ts})"
    rt = right.selectExpr("*", f"{at} AS {_RE}", f"explode(sequence(floor(({at} - {s}) / {width}), floor(({at} + {s}) / {width}))) AS {_RB}")
    on = [f"{lk} = {rk}" for lk, rk in zip(left_keys, right_keys, strict=True)]
    on.append(f"{_LB} = {_RB}")

    if hot_pairs:
        hot = hot_ranges(lt, rt, left_keys, right_keys, hot_pairs)
        if materialize:
            hot = materialize(hot, "hot_ranges")
        if not materialize or not hot.isEmpty():
            lt = _split(lt, hot, [*left_keys, _LB], "l", _ROW, _COL, _ROWS, _COLS)
            mirrored = hot.withColumnsRenamed(dict(zip([*left_keys, _LB], [*right_keys, _RB], strict=True)))
            rt = _split(rt, mirrored, [*right_keys, _RB], "r", _COL, _ROW, _COLS, _ROWS)
            on += [f"{c}_l = {c}_r" for c in (_ROW, _COL)]
            spread = False
    if spread:
        n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        lt, rt = lt.repartition(n, *left_keys, _LB), rt.repartition(n, *right_keys, _RB)

    # The exact band test and the residual go in a filter right above the
    # equi join rather than in its condition: Catalyst folds both (and any
    # filter a caller adds later, e.g. a costly publish gate) into the join
    # condition, and puts filter predicates first in their original order, so
    # the cheap band test runs before anything a caller stacks on top.
    test = [f"abs({_LE} - {_RE}) <= {s}"]
    if condition:
        test.append(f"({condition})")
    out = lt.join(rt, F.expr(" AND ".join(on)), "inner").where(" AND ".join(test))
    return out.drop(*_INNER)
