"""The published list by a bounded rank join (J13, E4 without building J10).

Only the best ``maximum_recommendations_per_day`` swaps of a site and day are
published, while candidates grow with the square of the shows. No swap of a
busy show A can bring more than A's unmet demand, as far as the largest quiet
screen within reach holds it, at A's price. Busy shows are visited in the order
of this bound: a round scores the next ones of every open (site, day) against
the quiet shows in their band, keeps the best swaps so far, and closes each day
whose last listed swap brings more than the bound of its next busy show. Rounds
grow geometrically; a day in which bounds tell nothing is scored whole, so the
list equals that of all candidates, ties included.

Tests of one show alone (lock, freeze window, confidence, bound below the
site's minimum) drop it before any pair is made. Per round the driver sees the
number of open days only. Batches are cut by a row limit per day that Spark
applies on the map side; a hot day is never sorted whole in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.exprs import capped_revenue_sql, money_sql
from slotwise.operators.band import SPAN
from slotwise.operators.topn import top_n_per_group
from slotwise.params import Params
from slotwise.plans.pairing import POLICY_COLUMNS, Materializer, band_pairs_of, busy_side, judged, quiet_side
from slotwise.plans.recommend import daily_top_n, publish_gate, recommendations
from slotwise.plans.stages import StageStore

DAY = ["a_theatre_id", "__day"]
CENTS = 0.02  #: each of a pair's two revenues is rounded to a cent


@dataclass
class RankJoin:
    """The list and what finding it took, per round."""

    recommendations: DataFrame
    pairs_scored: list[int] = field(default_factory=list)
    open_days: list[int] = field(default_factory=list)


def bounded_busy(busy: DataFrame, quiet: DataFrame, p: Params) -> DataFrame:
    """Busy shows that may be published, with their day and ``__bound``, which no swap of theirs exceeds.

    The largest screen is looked up per site and time range, halo ranges included;
    a quiet show of negative price may gain from a smaller screen, by its takings at most.
    """
    s = p.band_seconds
    reach = (
        quiet.selectExpr(
            "b_theatre_id", f"explode(sequence(floor((unix_timestamp(b_show_start_ts) - {s}) / {SPAN * s}), "
            f"floor((unix_timestamp(b_show_start_ts) + {s}) / {SPAN * s}))) AS __range",
            "b_screen_capacity AS seats",
            f"CAST(abs(least(0, {money_sql('b_average_ticket_price')}) * {money_sql('b_unconstrained_demand_forecast')}) AS DOUBLE) AS spared")
        .groupBy("b_theatre_id", "__range").agg(F.max("seats").alias("__seats"), F.max("spared").alias("__spared"))
    )
    ranged = busy.selectExpr("*", f"floor(unix_timestamp(a_show_start_ts) / {SPAN * s}) AS __range2")
    met = ranged.join(reach, F.expr("a_theatre_id = b_theatre_id AND __range2 = __range"))
    # Revenue is taken of amounts rounded to cents, so the bound is.
    fa, pa = "a_unconstrained_demand_forecast", "a_average_ticket_price"
    gain = f"CAST({capped_revenue_sql(fa, '__seats', pa)} - {capped_revenue_sql(fa, 'a_screen_capacity', pa)} AS DOUBLE)"
    bound = met.selectExpr(*busy.columns, "CAST(a_show_start_ts AS DATE) AS __day", f"greatest(0, {gain}) + coalesce(__spared, 0) + {CENTS} AS __bound")
    refused = ["a_is_locked", "a_hours_to_show <= a_freeze_window_hours", "a_forecast_confidence_score < a_minimum_confidence_score",
               "__bound < a_minimum_revenue_uplift"]
    return bound.where(" AND ".join(f"({test}) IS NOT TRUE" for test in refused))


def publishable(inputs: DataFrame, p: Params, hot_pairs: int | None = None, materialize: Materializer | None = None) -> DataFrame:
    """J13 of all candidates of ``inputs``: shows that no swap can publish make no pair, the gate judges every other one.

    Tests on numbers of both shows that need no money amounts run right above the join, before the revenues.
    """
    quiet = quiet_side(inputs).where("b_is_locked IS NOT TRUE")
    busy = bounded_busy(busy_side(inputs), quiet, p).drop("__day", "__bound")
    refused = ["b_hours_to_show <= a_freeze_window_hours", "b_forecast_confidence_score < a_minimum_confidence_score"]
    pairs = band_pairs_of(busy, quiet, p, hot_pairs, materialize).where(" AND ".join(f"({test}) IS NOT TRUE" for test in refused))
    return publish_gate(judged(pairs, p))


def rank_join(inputs: DataFrame, p: Params, cap: int | None, store: StageStore, hot_pairs: int | None = None,
              first: int = 4, growth: int = 4) -> RankJoin:
    """The published list of ``inputs`` (pair inputs, written); ``cap`` bounds every site's daily maximum.

    The first round scores ``first`` busy shows per listed swap, each later one ``growth`` times as many as before.
    """
    quiet = quiet_side(inputs).where("b_is_locked IS NOT TRUE")
    left = store.stage(bounded_busy(busy_side(inputs), quiet, p), "bounded_busy")
    # A show that meets several policies of its site has a row for each: the order is total.
    order = ["__bound DESC", "a_showtime_id ASC NULLS LAST", *(f"a_{c} ASC NULLS LAST" for c in POLICY_COLUMNS)]
    done, most = 0, first * max(1, cap or 1)
    best, pairs, days = None, [], []
    while True:
        ahead = top_n_per_group(left, DAY, order, most + 1, cap=most + 1, rank_col="__place")
        batch = ahead.where(f"__place > {done} AND __place <= {most}").drop("__place", "__bound", "__day")
        # Written, so that gate and limit filter a scan: above the projection they would be planned for each of its columns.
        scored = store.stage(judged(band_pairs_of(batch, quiet, p, hot_pairs, store.stage), p, with_run_ts=False), f"scored_{most}")
        found = daily_top_n(publish_gate(scored), cap).drop("show_date")
        best = store.stage(found if best is None else daily_top_n(best.unionByName(found), cap).drop("show_date"), f"best_{most}")
        pairs.append(store.metrics(f"scored_{most}")["rows"])
        store.release(f"scored_{most}")
        last = best.groupBy(F.col("theatre_id").alias("site"), F.expr("CAST(show_start_ts AS DATE)").alias("day")).agg(
            F.count(F.lit(1)).alias("n"), F.max("maximum_recommendations_per_day").alias("most"), F.min("estimated_ticket_revenue_uplift").alias("least"))
        following = ahead.where(f"__place = {most + 1}").select(*DAY, "__bound")
        met = following.join(last, F.expr("a_theatre_id = site AND __day = day"), "left")
        open_days = store.stage(met.where("n IS NULL OR n < most OR __bound >= least").select(*DAY), f"open_{most}")
        days.append(open_days.count())
        if not days[-1]:
            return RankJoin(recommendations(best, p, cap), pairs, days)
        left = left.join(open_days, DAY, "left_semi")
        done, most = most, most * growth
