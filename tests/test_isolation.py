"""The isolation forest against a second one in plain Python, and exact quantiles."""

import hashlib
import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.operators import isolation
from marketlens.operators.isolation import FEATURES, fit, flag, isolation_forest, mean_path, score, tree_samples
from marketlens.operators.selection import exact_quantile
from marketlens.operators.timeseries import anomaly_report

PANEL = "day date, revenue double, orders long, sla_breach_rate double, aov double"


def panel_rows(n, outlier=None):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        revenue = 1_000_000.0 if i == outlier else float(rng.normal(1000, 50))
        rows.append((date(2025, 1, 1) + timedelta(days=i), round(revenue, 2), 10, float(rng.uniform(0, 0.3)), revenue / 10))
    return rows


def number(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16)


def path_mean(n):
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def grown(rows, trees, size, seed):
    """Per tree (splits, leaves), recursively."""
    prime = 2**31 - 1
    keyed = [(str(r[0]), [float(r[1]), float(r[2]), float(r[4]), float(r[3])]) for r in rows]
    limit = math.ceil(min(1.0, (size + 8 * math.sqrt(size)) / len(rows)) * prime)
    out = []
    for tree in range(trees):
        a, b = number(seed, "a", tree) % (prime - 1) + 1, number(seed, "b", tree) % prime
        drawn = sorted(((a * (number(seed, "row", i) % prime) + b) % prime, i, x) for i, x in keyed)
        sample = [x for d, _, x in drawn if d < limit][:size]
        most = math.ceil(math.log2(max(len(sample), 2)))
        last = max(1, math.ceil(math.log2(max(size, 2))))
        splits, leaves = {}, {}

        def grow(part, node, level, depth, tree=tree, most=most, last=last, splits=splits, leaves=leaves):
            if level == last:
                leaves[node] = (depth, len(part))
                return
            low, high = [min(c) for c in zip(*part, strict=True)], [max(c) for c in zip(*part, strict=True)]
            varies = [i for i in range(4) if high[i] > low[i]]
            if len(part) < 2 or level >= most or not varies:
                grow(part, 2 * node, level + 1, depth)
                return
            f = varies[number(seed, "feature", tree, node) % len(varies)]
            cut = low[f] + number(seed, "threshold", tree, node) / 2**52 * (high[f] - low[f])
            cut = low[f] if cut >= high[f] else cut
            splits[node] = (f, cut)
            grow([x for x in part if x[f] <= cut], 2 * node, level + 1, depth + 1)
            grow([x for x in part if x[f] > cut], 2 * node + 1, level + 1, depth + 1)

        grow(sample, 1, 0, 0)
        out.append((splits, leaves, last))
    return out


@pytest.mark.parametrize("n,size", [(30, 16), (200, 32), (12, 64)])
def test_forest_and_scores_equal_a_second_one(frame, n, size):
    rows = panel_rows(n, outlier=5)
    df = frame(PANEL, *rows).repartition(3)
    forest = fit(df, trees=6, size=size, seed=9)
    expected = grown(rows, 6, size, 9)
    got = forest.collect()
    for tree, (splits, leaves, _) in enumerate(expected):
        own = [r for r in got if r.tree == tree]
        assert {r.node: (r.feature, r.threshold) for r in own if r.feature >= 0} == splits
        assert {r.node: (r.depth, r["size"]) for r in own if r.feature < 0} == leaves
    scored = {r.day: r.raw_score for r in score(df, forest, trees=6, size=size).collect()}
    for day, revenue, orders, rate, aov in rows:
        x, total = [revenue, orders, aov, rate], 0.0
        for splits, leaves, last in expected:
            node = 1
            for _ in range(last):
                f, cut = splits.get(node, (0, math.inf))
                node = 2 * node + (x[f] > cut)
            depth, held = leaves[node]
            total += depth + path_mean(held)
        assert scored[day] == pytest.approx(-(2 ** (-total / 6 / path_mean(min(size, n)))), abs=2e-10)


def test_planted_outlier_scores_lowest_and_the_share_flagged_is_kept(frame):
    scored = isolation_forest(frame(PANEL, *panel_rows(400, outlier=123)))
    rows = scored.orderBy("iforest_score").collect()
    assert rows[0]["day"] == date(2025, 1, 1) + timedelta(days=123)
    flagged = sum(r["is_anomaly_iforest"] for r in rows)
    assert abs(flagged - 0.08 * 400) <= 1
    assert all(r["is_anomaly_iforest"] == (r["iforest_score"] < 0) for r in rows)


def test_same_seed_same_scores_whatever_the_partitioning(frame):
    df = frame(PANEL, *panel_rows(60))
    first = {r["day"]: r["iforest_score"] for r in isolation_forest(df, trees=20).collect()}
    again = {r["day"]: r["iforest_score"] for r in isolation_forest(df.repartition(5), trees=20).collect()}
    other = {r["day"]: r["iforest_score"] for r in isolation_forest(df, trees=20, seed=1).collect()}
    assert first == again
    assert first != other


def test_trees_draw_their_rows_without_replacement(frame):
    rows = tree_samples(frame(PANEL, *panel_rows(500)), FEATURES, ["day"], 5, 64, 1)
    drawn = rows.groupBy("tree").agg(F.count("x").alias("n"), F.count_distinct("x").alias("distinct")).collect()
    assert [(r["n"], r["distinct"]) for r in drawn] == [(64, 64)] * 5


def test_building_the_plans_runs_nothing(spark, frame):
    df = frame(PANEL, *panel_rows(20))
    spark.sparkContext.setJobGroup("building", "no jobs wanted")
    flag(score(df.withColumn("s", F.lit(1)), fit(df, trees=3), trees=3), 0.1, ["s"])
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []


def test_scoring_uses_no_python_and_one_broadcast_value(frame):
    df = frame(PANEL, *panel_rows(20))
    plan = score(df, fit(df, trees=3), trees=3)._jdf.queryExecution().executedPlan().toString()
    rows_scored = plan[: plan.index("Subquery")] if "Subquery" in plan else plan
    assert "Python" not in rows_scored and "InPandas" not in rows_scored and "Join" not in rows_scored


def test_short_series_is_not_scored(frame):
    short = isolation_forest(frame(PANEL, *panel_rows(9))).collect()
    assert len(short) == 9 and all(r["is_anomaly_iforest"] is False and r["iforest_score"] == 0.0 for r in short)
    assert isolation_forest(frame(PANEL, *panel_rows(10)), trees=10).filter("is_anomaly_iforest").count() >= 1
    assert isolation_forest(frame(PANEL, *panel_rows(1)).limit(0), trees=3).count() == 0


def test_unknown_features_count_as_zero(frame):
    rows = [*panel_rows(20), (date(2026, 1, 1), None, 1, float("nan"), float("inf"))]
    scored = isolation_forest(frame(PANEL, *rows), trees=10).collect()
    assert len(scored) == 21 and all(r["iforest_score"] is not None for r in scored)


def test_combined_flag_is_either_detector(frame):
    rows = anomaly_report(frame(PANEL, *panel_rows(40, outlier=20)), threshold=1.8).collect()
    assert all(r["is_anomaly"] == (r["is_anomaly_statistical"] or r["is_anomaly_iforest"]) for r in rows)
    assert any(r["is_anomaly"] for r in rows)


def test_mean_path_length(frame):
    got = [r[0] for r in frame("n int", (1,), (2,), (256,)).select(mean_path("n")).collect()]
    assert got == [0.0, 1.0, pytest.approx(10.2448, abs=1e-3)]


def test_levels():
    assert [isolation.levels_of(n) for n in (1, 2, 3, 16, 17, 256)] == [1, 1, 2, 4, 5, 8]


# --- exact quantiles -----------------------------------------------------------------------


def quantile(values, share):
    values = sorted(map(float, values))
    rank = (len(values) - 1) * share
    low, high = values[math.floor(rank)], values[math.ceil(rank)]
    return low + (high - low) * (rank - math.floor(rank))


@pytest.mark.parametrize("share", [0.0, 0.08, 0.5, 0.999, 1.0])
def test_quantiles_of_many_series(spark, share):
    rng = np.random.default_rng(3)
    series = {
        "even": rng.uniform(0, 1, 3000), "one": [4.5], "two": [1.0, 2.0], "ties": [7.0] * 500 + [8.0] * 500,
        "stretched": [*rng.normal(0, 1, 500), 1e300, -1e300], "wide": [*rng.lognormal(0, 20, 800)], "zero": [-0.0, 0.0, 0.0],
    }
    rows = [(s, float(v), 1) for s, values in series.items() for v in values] + [("one", None, 1), ("none", None, 1)]
    df = spark.createDataFrame(rows, "s string, v double, n int").repartition(4)
    for bins, rounds in ((1024, 2), (4, 3), (8, 0)):
        got = {r.s: (r.n, r["quantile"]) for r in exact_quantile(df, "v", share, ["s"], bins, rounds).collect()}
        assert got == {s: (len(v), quantile(v, share)) for s, v in series.items()}


def test_quantile_sorts_no_series_in_one_task(spark):
    df = spark.range(200_000, numPartitions=8).selectExpr("0 as s", "cast(id * 7919 % 200003 as double) as v")
    result = exact_quantile(df, "v", 0.25, ["s"])
    assert result.first()["quantile"] == quantile([i * 7919 % 200003 for i in range(200_000)], 0.25)
    assert "percentile" not in result._jdf.queryExecution().optimizedPlan().toString()
