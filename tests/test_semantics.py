"""Rules that small hand-made inputs decide."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException

from marketlens.functions.columns import decimal_text, round_even, round_up
from marketlens.operators import expectations, forecast, kpis, model, quality, reports, rules, staging, timeseries
from marketlens.operators.dedup import keep_one
from marketlens.sources.sinks import json_records
from pyspark.sql import functions as F

ORDERS = (
    "order_id string, customer_id string, product_id string, warehouse_id string, timestamp string, "
    "quantity int, amount double, status string"
)
FACT_ORDERS = (
    "order_key string, customer_key string, product_key string, warehouse_key string, timestamp timestamp_ntz, "
    "quantity int, amount double, margin_amount double, status string"
)
PANEL = "day date, revenue double, orders long, sla_breach_rate double, aov double"


def order(key, amount=10.0, ts="2025-01-01 00:00:00", customer="C1", product="P1"):
    return (key, customer, product, "WH01", ts, 1, amount, "completed")


def sale(key, day, amount, customer="C1", product="P1", quantity=1, status="completed"):
    ts = datetime.combine(day, datetime.min.time())
    return (key, customer, product, "WH01", ts, quantity, amount, amount / 2, status)


def series(revenues, start=date(2025, 1, 1)):
    return [(start + timedelta(days=i), float(r), 1, 0.0, float(r)) for i, r in enumerate(revenues)]


def values(df):
    return {(r["metric"], r["dims"]): r["value"] for r in df.collect()}


@pytest.fixture
def customers(frame):
    return frame("customer_id string, segment string", ("C1", "A"), ("C2", None))


@pytest.fixture
def products(frame):
    return frame("product_id string, cost double, selling_price double", ("P1", 4.0, 9.0))


# --- deduplication and screening ----------------------------------------------------


def test_copy_with_largest_order_column_is_kept(frame):
    df = frame("k string, v int, w string", ("a", 1, "x"), ("a", 2, "y"), ("b", None, "z"))
    kept = keep_one(df, ["k"], ["v"]).orderBy("k").collect()
    assert [tuple(r) for r in kept] == [("a", 2, "y"), ("b", None, "z")]


def test_ties_are_settled_by_the_remaining_columns(frame):
    df = frame("k string, v int, w string", ("a", 1, None), ("a", 1, "y"), ("a", 1, "x"))
    assert keep_one(df, ["k"], ["v"]).first()["w"] == "x"


def test_key_disappears_when_its_latest_copy_is_bad(frame, customers, products):
    raw = frame(
        ORDERS,
        order("O1", 5.0, "2025-01-01 00:00:00"),
        order("O1", 7.0, "2025-01-02 00:00:00"),
        order("O1", -1.0, "2025-01-03 00:00:00"),
    )
    screened = quality.screen_orders(raw, customers, products)
    assert quality.accepted(screened).count() == 0
    assert staging.stg_orders(raw).count() == 0
    counts = {r["rule"]: r["failed_rows"] for r in quality.counters("orders", raw, screened).collect()}
    assert counts["duplicate_order_id"] == 2
    assert counts["negative_amount"] == 1
    assert counts["rows_dropped_total"] == 3


def test_row_is_charged_to_the_first_rule_it_fails(frame, customers, products):
    raw = frame(
        ORDERS,
        order("O1"),
        order("O2", -1.0, "bad", customer="nobody"),
        order("O3", -1.0, "bad"),
        order("O4", 1.0, "bad"),
        order("O5", 1.0, product="P9"),
        order(None),
        order("O6", None),
    )
    screened = quality.screen_orders(raw, customers, products)
    counts = {r["rule"]: r["failed_rows"] for r in quality.counters("orders", raw, screened).collect()}
    assert counts == {
        "duplicate_order_id": 0,
        "referential_integrity_customer_or_product": 2,
        "negative_amount": 1,
        "invalid_timestamp": 1,
        "rows_dropped_total": 6,
    }
    assert [r["order_id"] for r in quality.accepted(screened).collect()] == ["O1"]
    assert quality.rejected(screened).count() == 4


def test_arrival_order_decides_where_it_is_known(frame):
    ddl = "warehouse_id string, product_id string, available_qty int, reserved_qty int, updated_at string, _arrival struct<row: long>"
    raw = frame(ddl, ("W", "P", 1, 0, "2025-01-09", (0,)), ("W", "P", 2, 0, "2025-01-01", (1,)))
    assert quality.accepted(quality.screen_inventory(raw)).first()["available_qty"] == 2
    tickets = frame("ticket_id string, created_at string, _arrival struct<row: long>", ("T", "a", (0,)), ("T", "b", (1,)))
    assert quality.accepted(quality.screen_support(tickets)).first()["created_at"] == "a"


def test_null_quantity_is_kept_in_silver_and_dropped_in_staging(frame):
    ddl = "warehouse_id string, product_id string, available_qty int, reserved_qty int, reorder_level int, updated_at string"
    raw = frame(ddl, ("W", "P", None, 0, 5, "2025-01-01 00:00:00"), ("W", "Q", -1, 0, 5, "2025-01-01 00:00:00"))
    assert [r["product_id"] for r in quality.accepted(quality.screen_inventory(raw)).collect()] == ["P"]
    assert staging.stg_inventory(raw).count() == 0


def test_missing_price_is_counted_with_missing_keys(frame):
    raw = frame("product_id string, selling_price double", ("P1", None), ("P2", 0.0), ("P3", 2.0), (None, 1.0))
    screened = quality.screen_products(raw)
    counts = {r["rule"]: r["failed_rows"] for r in quality.counters("products", raw, screened).collect()}
    assert counts == {"non_positive_selling_price": 1, "null_or_dup_product_id": 2}


def test_order_of_a_product_refused_for_its_price_is_an_orphan(frame, customers):
    catalogue = quality.accepted(quality.screen_products(frame("product_id string, selling_price double", ("P1", 0.0))))
    screened = quality.screen_orders(frame(ORDERS, order("O1")), customers, catalogue)
    assert quality.rejected(screened).first()["reject_reason"] == "referential_integrity_customer_or_product"


def test_strict_staging_stops_on_bad_values(frame):
    raw = frame(ORDERS, order("O1", 1.0, "not a time"))
    with pytest.raises(PySparkException):
        staging.stg_orders(raw).collect()
    assert staging.stg_orders(raw, strict=False).first()["order_ts"] is None


def test_blank_resolution_time_is_no_error(frame):
    ddl = "ticket_id string, customer_id string, order_id string, issue_type string, priority string, created_at string, resolved_at string"
    raw = frame(ddl, ("T1", "C", "O", "i", "p", "2025-01-01 00:00:00", ""))
    assert staging.stg_support(raw).first()["resolved_at"] is None


# --- star schema --------------------------------------------------------------------


def test_elapsed_and_boundary_hours_differ(frame):
    ddl = "order_id string, partner string, pickup_time timestamp_ntz, expected_delivery timestamp_ntz, actual_delivery timestamp_ntz, status string"
    a, b = datetime(2025, 1, 1, 10, 59), datetime(2025, 1, 1, 11, 1)
    delivery = frame(ddl, ("O1", "p", a, None, b, "delivered"))
    orders = frame("order_id string, warehouse_id string", ("O1", "WH01"))
    exact, marks = model.fact_delivery(delivery, orders).first(), model.fact_delivery_staged(delivery, orders).first()
    assert (exact["delivery_hours"], marks["delivery_hours"]) == (0.03, 1)
    assert exact["sla_breached"] is False
    assert exact["warehouse_key"] == "WH01"


def test_marketing_ratios_on_zero_denominators(frame):
    ddl = "campaign_id string, date date, channel string, spend double, impressions int, clicks int, conversions int"
    raw = frame(ddl, ("C", date(2025, 1, 1), "ch", 5.0, 0, 0, 0))
    gold = model.fact_marketing(raw).first()
    assert (gold["ctr"], gold["conversion_rate"], gold["cac"]) == (None, None, None)
    staged = model.fact_marketing_staged(raw.withColumnRenamed("date", "campaign_date")).first()
    assert (staged["ctr"], staged["conversion_rate"], staged["cac"]) == (0.0, 0.0, None)
    orders = frame(FACT_ORDERS, sale("O1", date(2025, 1, 1), 4.0))
    figures = values(kpis.marketing_kpis(model.fact_marketing(raw), orders))
    assert (figures["ctr_pct", ""], figures["conversion_rate_pct", ""], figures["cac", ""]) == (0.0, 0.0, None)


def test_unknown_cost_is_zero_in_gold_and_null_in_staging(frame, customers, products):
    raw = frame(ORDERS, order("O1", product="P9"))
    gold = model.fact_orders(raw.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), products).first()
    assert (gold["cost_total"], gold["margin_amount"]) == (0.0, 10.0)
    full = products.selectExpr("*", "'c' as category", "'b' as brand")
    people = customers.selectExpr("*", "'x' as city")
    staged = model.orders_enriched(staging.stg_orders(raw), full, people).first()
    assert (staged["cost_total"], staged["margin_amount"]) == (None, None)


def test_calendar_has_every_day_of_the_fixed_range(spark):
    days = model.dim_date(spark)
    assert days.count() == 730
    saturday = days.filter("date_key = 20250201").first()
    assert (saturday["month_name"], saturday["day_of_week"], saturday["is_weekend"]) == ("February", "Saturday", True)
    assert days.filter("date_key = 20250203").first()["is_weekend"] is False


@pytest.mark.parametrize(
    ("value", "text"), [(56.25, "56.2"), (55.75, "55.8"), (-0.04, "-0.0"), (99.96, "100.0"), (18.35, "18.4"), (0.35, "0.3"), (0.25, "0.2"), (-2.25, "-2.2")]
)
def test_one_decimal_text_follows_the_binary_value(frame, value, text):
    assert f"{value:.1f}" == text
    assert frame("x double", (value,)).select(decimal_text("x")).first()[0] == text


def test_one_decimal_text_of_many_values(spark):
    rows = spark.range(20001).selectExpr("(id - 10000) / 80D as x").select("x", decimal_text("x").alias("text")).collect()
    assert [(r["x"], r["text"]) for r in rows if f"{r['x']:.1f}" != r["text"]] == []


def test_rounding_variants(frame):
    row = frame("x double", (2.5,)).select(round_even(F.col("x"), 0), round_up(F.col("x"), 0)).first()
    assert tuple(row) == (2.0, 3.0)


# --- KPIs ---------------------------------------------------------------------------


def test_growth_compares_months_that_have_sales(frame):
    orders = frame(
        FACT_ORDERS,
        sale("O1", date(2025, 1, 5), 100.0),
        sale("O2", date(2025, 3, 5), 150.0),
        sale("O3", date(2025, 4, 5), 999.0, status="pending"),
    )
    assert values(kpis.sales_kpis(orders))["mom_revenue_growth_pct", ""] == 50.0


def test_sales_figures_without_orders(frame):
    figures = values(kpis.sales_kpis(frame(FACT_ORDERS)))
    assert figures["total_orders", ""] == 0.0
    assert figures["average_order_value", ""] == 0.0
    assert figures["mom_revenue_growth_pct", ""] is None


def test_delivery_figures_without_deliveries(frame):
    empty = frame("partner string, sla_breached boolean, delivery_hours double")
    figures = values(kpis.delivery_kpis(empty))
    assert (figures["on_time_delivery_pct", ""], figures["sla_breach_pct", ""]) == (0.0, 100.0)


def test_customers_without_segment_are_left_out_of_segment_rows_only(frame):
    people = frame(
        "customer_key string, segment string, registration_date date",
        ("C1", "A", date(2025, 1, 1)),
        ("C2", None, date(2025, 3, 1)),
    )
    orders = frame(
        FACT_ORDERS,
        sale("O1", date(2025, 1, 5), 1.0, "C1"),
        sale("O2", date(2025, 1, 6), 1.0, "C1"),
        sale("O3", date(2025, 1, 7), 1.0, "C2"),
    )
    figures = values(kpis.customer_kpis(orders, people))
    assert figures == {
        ("total_customers", ""): 2.0,
        ("new_customers_last_30d", ""): 1.0,
        ("repeat_customer_rate_pct", ""): 50.0,
        ("orders_by_segment", "segment=A"): 2.0,
    }


def test_turnover_is_the_mean_of_product_ratios(frame):
    stock = frame(
        "product_key string, stock_position int, below_reorder_level boolean",
        ("P1", 10, False),
        ("P2", 0, True),
        ("P3", 5, True),
    )
    orders = frame(
        FACT_ORDERS,
        sale("O1", date(2025, 1, 1), 1.0, product="P1", quantity=20),
        sale("O2", date(2025, 1, 1), 1.0, product="P2", quantity=7),
        sale("O3", date(2025, 1, 1), 1.0, product="P9", quantity=7),
    )
    figures = values(kpis.inventory_kpis(stock, orders))
    assert figures["inventory_turnover_ratio", ""] == 2.0
    assert figures["days_of_inventory", ""] == 182.5
    assert (figures["stockout_risk_item_count", ""], figures["items_below_reorder_level", ""]) == (1.0, 2.0)


def test_unknown_domain_is_an_error(frame):
    snapshot = frame("domain string, metric string, value double, dims string", ("sales", "m", 1.0, ""))
    assert reports.kpis_by_domain(snapshot, "sales").count() == 1
    with pytest.raises(LookupError):
        reports.kpis_by_domain(snapshot, "nothing")


# --- time series --------------------------------------------------------------------


def test_zscore_needs_three_rows(frame):
    rows = timeseries.rolling_zscore(frame(PANEL, *series([1, 2, 9]))).orderBy("day").collect()
    assert [r["revenue_zscore"] is None for r in rows] == [True, True, False]


def test_constant_revenue_has_no_zscore(frame):
    rows = timeseries.rolling_zscore(frame(PANEL, *series([100000.1] * 10))).collect()
    assert all(r["revenue_zscore"] is None and r["is_anomaly_statistical"] is False for r in rows)


def test_spike_inside_its_own_frame_stays_below_the_bound(frame):
    panel = frame(PANEL, *series([10, 11, 10, 11, 10, 11, 100000]))
    last = timeseries.rolling_zscore(panel).orderBy(F.desc("day")).first()
    assert 2.2 < last["revenue_zscore"] < 2.2679
    assert last["is_anomaly_statistical"] is False
    assert timeseries.rolling_zscore(panel, threshold=1.8).filter("is_anomaly_statistical").count() == 1
    assert timeseries.rolling_zscore(panel, include_current=False).filter("is_anomaly_statistical").count() == 1


def test_explanation_names_the_largest_changes_first(frame):
    calm = [(date(2025, 1, 1) + timedelta(days=i), 100.0, 10, 0.1, 10.0) for i in range(7)]
    drop = (date(2025, 1, 8), 50.0, 9, 0.4, 5.5)
    rows = timeseries.explain_days(frame(PANEL, *calm, drop)).orderBy("day").collect()
    assert rows[0]["explanation"] == timeseries.NO_HISTORY
    assert rows[0]["recommended_action"] == ""
    assert rows[3]["explanation"] == timeseries.NO_DRIVER
    assert rows[7]["explanation"] == (
        "SLA breach rate was up 300.0% vs. the trailing 7-day average; "
        "revenue was down 50.0% vs. the trailing 7-day average; "
        "average order value was down 45.0% vs. the trailing 7-day average"
    )
    assert rows[7]["recommended_action"] == timeseries.ACTION_SLA
    assert rows[7]["baseline_avg_revenue"] == 100.0


def test_worst_day_comes_first_then_two_more_in_day_order(frame):
    ddl = (
        "day date, revenue double, revenue_zscore double, is_anomaly boolean, baseline_avg_revenue double, "
        "explanation string, recommended_action string"
    )
    days = [date(2025, 1, d) for d in range(1, 6)]
    z = [1.0, None, -5.0, 2.0, 9.0]
    report = frame(ddl, *[(d, 1.0, s, d.day != 5, 1.0, "", "") for d, s in zip(days, z)])
    picked = timeseries.pick_explanations(report).orderBy("place").collect()
    assert [r["day"].day for r in picked] == [3, 1, 2]


def test_forecast_needs_fourteen_days(frame):
    assert forecast.revenue_forecast(frame(PANEL, *series(range(13)))).count() == 0
    assert forecast.revenue_forecast(frame(PANEL, *series(range(14)))).count() == 7


def test_forecast_continues_an_exact_line(frame):
    rows = forecast.revenue_forecast(frame(PANEL, *series([100 + 10 * i for i in range(21)]))).orderBy("forecast_day")
    found = rows.collect()
    assert [r["predicted_revenue"] for r in found] == [310.0 + 10 * i for i in range(7)]
    assert found[0]["forecast_day"] == date(2025, 1, 22)
    assert all(abs(r["upper_bound_80pct"] - r["predicted_revenue"]) < 0.02 for r in found)


def test_weekday_never_seen_takes_the_level_of_the_smallest_weekday(frame):
    days = [date(2025, 1, 6) + timedelta(days=i) for i in range(28)]
    rows = [(d, 100.0 if d.weekday() == 0 else 300.0, 1, 0.0, 1.0) for d in days if d.weekday() != 6]
    found = {r["forecast_day"].weekday(): r for r in forecast.revenue_forecast(frame(PANEL, *rows)).collect()}
    assert found[6]["predicted_revenue"] == pytest.approx(100.0, abs=0.01)
    assert found[5]["predicted_revenue"] == pytest.approx(300.0, abs=0.01)


def test_forecast_is_clamped_at_zero(frame):
    rows = forecast.revenue_forecast(frame(PANEL, *series([1000 - 80 * i for i in range(14)]))).collect()
    assert all(r["predicted_revenue"] == 0.0 and r["lower_bound_80pct"] == 0.0 for r in rows)


# --- rules --------------------------------------------------------------------------


def test_forecast_from_all_days_never_matches_and_an_earlier_one_does(frame):
    daily = frame(PANEL, *series([100] * 20 + [10]))
    current = forecast.revenue_forecast(daily)
    earlier = forecast.revenue_forecast(daily.filter("day < date '2025-01-20'"))
    assert rules.revenue_alerts(daily, current).count() == 0
    alert = rules.revenue_alerts(daily, earlier).first()
    assert alert["severity"] == "CRITICAL"
    assert alert["message"] == "Revenue on 2025-01-21 was 10, 90.0% below the forecast of 100."


def test_stockout_rule_and_recent_demand(frame):
    orders = frame(
        FACT_ORDERS,
        sale("O1", date(2025, 1, 31), 1.0, product="P1", quantity=14),
        sale("O2", date(2025, 1, 24), 1.0, product="P2", quantity=70),
        sale("O3", date(2025, 1, 23), 1.0, product="P3", quantity=700),
    )
    stock = frame(
        "warehouse_key string, product_key string, stock_position int, below_reorder_level boolean",
        ("WH01", "P1", 5, True),
        ("WH02", "P1", 6, True),
        ("WH03", "P1", 1, False),
        ("WH01", "P2", -4, True),
        ("WH01", "P3", 1, True),
    )
    found = {r["entity"]: r["message"] for r in rules.stockout_alerts(stock, orders).collect()}
    assert set(found) == {"WH01:P1", "WH01:P2"}
    assert found["WH01:P1"] == (
        "Product P1 at warehouse WH01 is below reorder level (5 units) with ~2.0 units/day demand (~2.5 days of cover left)."
    )


def test_payment_rule(frame):
    ddl = "metric_key string, metric_value double"
    bad = frame(ddl, ("live_payments_total", 100.0), ("live_payment_failures_total", 6.0))
    assert rules.payment_alerts(bad).first()["message"] == (
        "Payment failure rate is 6.0% (6/100 payments), above the 5% threshold. Payments/engineering team notified."
    )
    assert rules.payment_alerts(bad, threshold=6.0).count() == 0
    assert rules.payment_alerts(frame(ddl)).count() == 0


def test_alert_numbers_are_dense_and_messages_go_to_the_outbox(frame):
    ddl = "rule string, severity string, status string, entity string, message string"
    alerts = frame(ddl, *[("r", "HIGH" if i % 2 else "LOW", "OPEN", f"e{i}", "m") for i in range(50)])
    numbered = rules.numbered(alerts, datetime(2025, 1, 1)).collect()
    assert sorted(int(r["alert_id"].split("-")[1]) for r in numbered) == list(range(1, 51))
    assert all(r["notified"] == (r["severity"] == "HIGH") for r in numbered)
    assert rules.outbox(alerts).count() == 25


def test_latest_valid_status_counts(frame):
    alerts = frame("alert_id string, status string", ("A1", "OPEN"), ("A2", "OPEN"))
    t = datetime(2025, 1, 1)
    events = frame(
        "alert_id string, status string, changed_at timestamp_ntz",
        ("A1", "RESOLVED", t + timedelta(hours=2)),
        ("A1", "ACKNOWLEDGED", t),
        ("A1", "CLOSED", t + timedelta(hours=3)),
        ("A9", "RESOLVED", t),
    )
    assert {r[0]: r[1] for r in rules.current_status(alerts, events).collect()} == {"A1": "RESOLVED", "A2": "OPEN"}
    valid, refused = rules.split_status_events(events, alerts)
    assert valid.count() == 2
    assert {r["refused_because"] for r in refused.collect()} == {"invalid status", "alert not found"}


# --- checks and records -------------------------------------------------------------


def test_expectations_count_failures(frame):
    df = frame("k string, v double, w double", ("a", 1.0, 2.0), ("a", -1.0, -2.0), (None, 3.0, 4.0))
    parent = frame("k string", ("b",))
    parts = [
        expectations.expect_unique(df, "t", "k"),
        expectations.expect_not_null(df, "t", ["k", "v"]),
        expectations.expect_related(df, "t", "k", parent, "k"),
        expectations.expect_at_least(df, "t", "v", 0),
        expectations.expect_ordered(df, "t", ["v", "w"]),
        expectations.expect_in(df, "t", "k", ["b"]),
        expectations.expect_present(df, "t", "k", ["a", "z"]),
        expectations.expect_rows(df.filter("v > 99"), "t"),
    ]
    found = [(r["check_name"], r["column_name"], r["failures"]) for p in parts for r in p.collect()]
    assert found == [
        ("unique", "k", 1),
        ("not_null", "k", 1),
        ("not_null", "v", 0),
        ("relationships", "k", 2),
        ("at_least", "v", 1),
        ("ordered", "v", 1),
        ("accepted_values", "k", 2),
        ("required_values", "k", 1),
        ("not_empty", "*", 1),
    ]


def test_records_write_nan_as_null(frame):
    df = frame("a double, b string", (float("nan"), "x"), (1.5, None))
    assert sorted(r[0] for r in json_records(df).collect()) == ['{"a":1.5,"b":null}', '{"a":null,"b":"x"}']
