"""First failing rule wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_failure_sql(rules: Sequence[tuple[str, str]], passed: str = "") -> str:
    """Name of the first rule whose test is TRUE, else ``passed`` (SQL text).

    A NULL test is not TRUE and falls through to the next rule, as in SQL CASE.
    """
    def lit(s: str) -> str:
        return "'" + s.replace("'", "\\'") + "'"

    if not rules:
        return lit(passed)
    arms = " ".join(f"WHEN {test} THEN {lit(name)}" for test, name in rules)
    return f"CASE {arms} ELSE {lit(passed)} END"


def first_failure(rules: Sequence[tuple[str, str]], passed: str = "") -> Column:
    """Column version of :func:`first_failure_sql` (tests are SQL text)."""
    return F.expr(first_failure_sql(rules, passed))
