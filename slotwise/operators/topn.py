"""Top-N per group with N taken from a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int | str,
    cap: int | None = None,
    rank_col: str | None = None,
) -> DataFrame:
    """Rows ranked ``<= n`` within each group; ``n`` may be a column or expression.

    With a per-row ``n`` Catalyst cannot prune before the shuffle. Passing
    ``cap`` (a literal upper bound of ``n``, e.g. the largest per-site cap)
    adds a redundant ``rank <= cap`` that re-enables the partial
    WindowGroupLimit, so a hot group is cut to ``cap`` rows per map task.
    """
    rk = rank_col or "__topn_rank"
    w = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) AS {rk}"
    cond = f"{rk} <= {n}"
    if cap is not None:
        cond = f"{rk} <= {int(cap)} AND {cond}"
    out = df.selectExpr("*", w).where(cond)
    return out if rank_col else out.drop(rk)
