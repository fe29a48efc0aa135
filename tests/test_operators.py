"""Generic operators against brute force on small literal inputs."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from slotwise.operators import band_join, first_failure, latest_by_key, top_n_per_group


def _events(n, seed):
    rnd = random.Random(seed)
    base = datetime(1969, 12, 31, 23, 0)  # crosses the epoch: negative seconds too
    return [(i, rnd.randint(0, 2), base + timedelta(seconds=rnd.randint(0, 7200))) for i in range(n)]


def _brute(rows, seconds):
    out = set()
    for i, k, t in rows:
        for j, k2, t2 in rows:
            if k == k2 and i != j and abs(int((t - t2).total_seconds())) <= seconds:
                out.add((i, j))
    return out


def _band(spark, rows, seconds, hot_pairs=None):
    df = spark.createDataFrame(rows, "id long, k int, ts timestamp_ntz")
    a = df.select(*[F.col(c).alias("a_" + c) for c in df.columns])
    b = df.select(*[F.col(c).alias("b_" + c) for c in df.columns])
    j = band_join(a, b, ["a_k"], ["b_k"], "a_ts", "b_ts", seconds, condition="a_id <> b_id", hot_pairs=hot_pairs)
    got = [(r["a_id"], r["b_id"]) for r in j.select("a_id", "b_id").collect()]
    assert len(got) == len(set(got)), "each pair must meet exactly once"
    return set(got)


def test_band_join_equals_brute_force(spark):
    rows = _events(120, 1)
    for seconds in (1, 60, 900):
        assert _band(spark, rows, seconds) == _brute(rows, seconds)


def test_band_join_salted_hot_groups_give_the_same_pairs(spark):
    rows = _events(150, 2)
    assert _band(spark, rows, 900, hot_pairs=3) == _brute(rows, 900)


def test_band_join_edges(spark):
    t = datetime(2026, 7, 2, 19)
    rows = [(1, 0, t), (2, 0, t + timedelta(seconds=900)), (3, 0, t + timedelta(seconds=1801)),
            (4, 0, t + timedelta(seconds=900, microseconds=900000))]  # 900.9 s counts as 900
    got = _band(spark, rows, 900)
    assert (1, 2) in got and (2, 1) in got and (1, 4) in got and (1, 3) not in got and (2, 3) not in got


def test_latest_by_key_orders_then_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "p"), ("b", 0, "q")], "k string, v int, s string"
    )
    got = {r["k"]: (r["v"], r["s"]) for r in latest_by_key(df, ["k"], ["v DESC NULLS LAST"]).collect()}
    assert got == {"a": (2, "z"), "b": (0, "q")}  # NULL sorts last; tie -> other columns descending


def test_top_n_with_column_limit_and_cap(spark):
    df = spark.createDataFrame(
        [("s", 5, 1, 2), ("s", 9, 2, 2), ("s", 9, 3, 2), ("s", 1, 4, 2), ("t", 3, 5, 1), ("t", 4, 6, 1)],
        "g string, score int, id int, n int",
    )
    out = top_n_per_group(df, ["g"], ["score DESC", "id ASC"], "n", cap=2, rank_col="rk")
    got = sorted((r["g"], r["id"], r["rk"]) for r in out.collect())
    assert got == [("s", 2, 1), ("s", 3, 2), ("t", 6, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_first_failure_null_falls_through(spark):
    df = spark.createDataFrame([(None, True), (True, False), (False, None), (False, False)], "a boolean, b boolean")
    out = df.select(first_failure([("a", "A"), ("b", "B")]).alias("r"))
    assert [r["r"] for r in out.collect()] == ["B", "A", "", ""]


def test_a_range_hot_on_both_sides_is_spread_evenly(spark):
    """3,000 x 3,000 rows of one site in one range, beside quiet sites: no task makes twice the median's pairs."""
    n, day = 3000, datetime(2026, 7, 1, 12)
    rows = [(i, 0, day + timedelta(seconds=i % 60)) for i in range(n)] + [(n + i, 1 + i % 50, day + timedelta(seconds=37 * i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, k int, ts timestamp_ntz").repartition(8)
    a, b = (df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns]) for side in "ab")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        pairs = band_join(a, b, ["a_k"], ["b_k"], "a_ts", "b_ts", 900, hot_pairs=n * n // 1024)
        made = sorted(r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect())
        assert len(made) == 16 and made[-1] <= 2 * made[len(made) // 2]
        want = sum(1 for x in rows[n:] for y in rows[n:] if x[1] == y[1] and abs((x[2] - y[2]).total_seconds()) <= 900)
        assert sum(made) == n * n + want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_right_rows_are_copied_across_boundaries_only(spark):
    rows = [(i, 0, datetime(2026, 7, 1) + timedelta(seconds=450 * i)) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, k int, ts timestamp_ntz")
    a, b = (df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns]) for side in "ab")
    plan = band_join(a, b, ["a_k"], ["b_k"], "a_ts", "b_ts", 900)._jdf.queryExecution()
    copied = b.selectExpr("explode(sequence(floor((unix_timestamp(b_ts) - 900) / 3600), floor((unix_timestamp(b_ts) + 900) / 3600))) AS r").count()
    assert "sequence(" in plan.analyzed().toString() and len(rows) < copied <= 1.7 * len(rows)


def test_band_join_of_nulls_and_clashing_names(spark):
    t = datetime(2026, 7, 1)
    a = spark.createDataFrame([(1, 1, t), (2, None, t), (3, 1, None)], "rows long, a_k int, a_ts timestamp_ntz")
    b = spark.createDataFrame([(1, 1, t), (2, None, t), (3, 1, None), (4, 1, t + timedelta(seconds=900)), (4, 1, t - timedelta(seconds=901))], "cols long, b_k int, b_ts timestamp_ntz")
    for hot in (None, 1):
        got = band_join(a, b, ["a_k"], ["b_k"], "a_ts", "b_ts", 900, hot_pairs=hot)
        assert got.columns == ["rows", "a_k", "a_ts", "cols", "b_k", "b_ts"]
        assert sorted((r["rows"], r["cols"]) for r in got.collect()) == [(1, 1), (1, 4)]
