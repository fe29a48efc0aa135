"""Data-quality audit and hard gates.

Audit, counts and gate are projections of a few facts (counts and sums). The
facts are observed by the jobs that write the tables, or taken by one pass
over tables that are there.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.exprs import quote
from slotwise.params import Params
from slotwise.plans.pairing import INVALID

_INVALID = f"constraint_validation_status = {quote(INVALID)}"

# What the checks need of each table, as aggregates: observed while the table
# is written (:mod:`slotwise.plans.stages`) or computed by one pass over it.
RECOMMENDATION_FACTS = {
    "recommendation_count": "count(1)",
    "bad_recommendation_count": "count_if(estimated_ticket_revenue_uplift <= 0 OR recommendation_reason IS NULL OR recommendation_reason = '')",
}
# SUM over no rows is NULL, so an empty candidate set fails the audit with a NULL detail.
CANDIDATE_FACTS = {
    "invalid_candidate_count": f"count_if({_INVALID})",
    "invalid_candidate_sum": f"sum(CASE WHEN {_INVALID} THEN 1 ELSE 0 END)",
}


class QualityGateError(AssertionError):
    """Raised when a published run breaks a hard output rule."""


def metrics(facts: dict[str, str]) -> dict[str, Column]:
    """Facts as aggregate columns."""
    return {name: F.expr(sql) for name, sql in facts.items()}


def facts(recommendations: DataFrame, candidates: DataFrame) -> DataFrame:
    """All facts as one row: a single pass over each side."""
    r = recommendations.agg(*(c.alias(n) for n, c in metrics(RECOMMENDATION_FACTS).items()))
    return r.crossJoin(candidates.agg(*(c.alias(n) for n, c in metrics(CANDIDATE_FACTS).items())))  # one row x one row


def observed_facts(spark: SparkSession, recommendations: Mapping, candidates: Mapping) -> DataFrame:
    """All facts as one row from what was observed when the two tables were written."""
    seen = {**recommendations, **candidates}
    names = [*RECOMMENDATION_FACTS, *CANDIDATE_FACTS]
    return spark.createDataFrame([tuple(seen[n] for n in names)], ", ".join(f"{n} long" for n in names))


def audit_of(found: DataFrame, p: Params = Params(), with_run_ts: bool = True) -> DataFrame:
    """K1 from the facts: one row per check with PASS/FAIL and a detail text."""
    checks = [
        ("gold_recommendations_min_count", "recommendation_count", "recommendation_count", p.min_recommendations),
        ("gold_candidates_invalid_present", "invalid_candidate_count", "invalid_candidate_sum", p.min_invalid_candidates),
    ]
    rows = ", ".join(
        f"named_struct('check_name', {quote(name)}, 'status', CASE WHEN {fact} >= {int(least)} THEN 'PASS' ELSE 'FAIL' END, "
        f"'detail', concat('{shown}=', CAST({fact} AS STRING)))"
        for name, shown, fact, least in checks
    )
    out = found.selectExpr(f"inline(array({rows}))")
    return out.selectExpr("current_timestamp() AS check_ts", "*") if with_run_ts else out


def audit(recommendations: DataFrame, candidates: DataFrame, p: Params = Params(), with_run_ts: bool = True) -> DataFrame:
    """K1 by a pass over both tables."""
    return audit_of(facts(recommendations, candidates), p, with_run_ts)


def counts_of(found: DataFrame) -> DataFrame:
    """K3 inputs from the facts."""
    return found.select("recommendation_count", "bad_recommendation_count", "invalid_candidate_count")


def check_counts(recommendations: DataFrame, candidates: DataFrame) -> DataFrame:
    """K3 inputs as one row, by a pass over both tables."""
    return counts_of(facts(recommendations, candidates))


def gate_of(found: DataFrame, p: Params = Params()) -> DataFrame:
    """K2 + K3 verdict from the facts, as one row: the counts, ``gate_passed`` and the first failure message."""
    rc, ic, bad = "recommendation_count", "invalid_candidate_count", "bad_recommendation_count"
    message = (
        f"CASE WHEN {rc} < {int(p.min_recommendations)} "
        f"THEN concat('Expected at least {int(p.min_recommendations)} recommendations, found ', CAST({rc} AS STRING)) "
        f"WHEN {ic} < {int(p.min_invalid_candidates)} THEN 'Expected at least one invalid candidate' "
        f"WHEN {bad} > 0 THEN concat('Found ', CAST({bad} AS STRING), ' invalid recommendation rows') END"
    )
    return found.selectExpr(rc, ic, bad, f"({message}) IS NULL AS gate_passed", f"{message} AS gate_message")


def gate(recommendations: DataFrame, candidates: DataFrame, p: Params = Params()) -> DataFrame:
    """K2 + K3 verdict by a pass over both tables."""
    return gate_of(facts(recommendations, candidates), p)


def enforce_facts(found: DataFrame, p: Params = Params()) -> dict[str, int]:
    """K2 + K3: raise :class:`QualityGateError` when a hard rule fails; return the counts."""
    row = gate_of(found, p).collect()[0].asDict()
    if not row["gate_passed"]:
        raise QualityGateError(row["gate_message"])
    return {k: row[k] for k in ("recommendation_count", "bad_recommendation_count", "invalid_candidate_count")}


def enforce(recommendations: DataFrame, candidates: DataFrame, p: Params = Params()) -> dict[str, int]:
    """:func:`enforce_facts` by a pass over both tables."""
    return enforce_facts(facts(recommendations, candidates), p)
