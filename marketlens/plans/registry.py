"""Registered queries: name -> function of (spark, sf_dir) giving a frame.

Every query reads the supplied tables in full. Columns that hold the time of the
run are left out, so that results can be compared.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators import (
    dedup,
    expectations,
    forecast,
    isolation,
    kpis,
    model,
    quality,
    reports,
    rules,
    timeseries,
)
from marketlens.plans.warehouse import ParentsOnce, ScreenedOnce, Warehouse
from marketlens.session import scratch_path, stored
from marketlens.sources import files, quarantine, sinks, testtables
from marketlens.sources.schemas import SOURCE_SCHEMAS, field_types
from marketlens.streaming import compaction, live, records
from marketlens.streaming.progress import ProgressTable

Query = Callable[[SparkSession, str], DataFrame]

# A z-score above 2.27 cannot occur with the current day inside a seven-row frame.
SENSITIVE = 1.8
# the run whose stored rows are compared, and the fixed calendar
RUN_TS = datetime(2025, 3, 1, 6, 30, tzinfo=timezone.utc)
_PLAIN_TIME = "cast({} as timestamp_ntz)"
CALENDAR = date(1995, 1, 1), date(1996, 12, 31)

_QUERIES: dict[str, Query] = {}


def _over_warehouse(name: str, kind: type[Warehouse] = Warehouse):
    """Registers a function of the warehouse under `name`."""

    def register(build: Callable[[Warehouse], DataFrame]):
        _QUERIES[name] = lambda spark, sf_dir: build(kind.over_test_tables(spark, sf_dir))
        return build

    return register


def _over_tables(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- silver and data quality --------------------------------------------------------

for _name in ("customers", "products", "orders", "inventory", "delivery", "support", "marketing"):
    _over_warehouse(f"silver_{_name}")(lambda w, n=_name: w.silver(n))
    _over_warehouse(f"stg_{_name}")(lambda w, n=_name: w.staged(n))

@_over_warehouse("dq_report")
def _dq_report(w: Warehouse) -> DataFrame:
    return quality.store_screened(w.sources, lambda name, df: stored(df, name))[1].drop("checked_at")


_over_warehouse("quality_checks")(lambda w: reports.pipeline_status(w.dq_report).drop("checked_at"))
_over_warehouse("rejected_orders")(lambda w: quality.rejected(w.screened("orders")))
_over_warehouse("duplicate_orders")(lambda w: dedup.duplicate_keys(w.sources["orders"], ["order_id"]))
_over_warehouse("orphan_customers_in_orders")(
    lambda w: expectations.orphans(w.sources["orders"], "customer_id", w.silver("customers"), "customer_id")
)
_over_warehouse("expectation_report", ScreenedOnce)(
    lambda w: expectations.store_checked(w.gold(), lambda name, df: stored(df, name))[1]
)


@_over_tables
def quality_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ScreenedOnce.over_test_tables(spark, sf_dir)
    alerts = _alerts(spark, sf_dir, w)
    parts = [expectations.expect_rows(w.silver(n), f"silver_{n}") for n in w.sources]
    parts += [
        expectations.expect_at_least(w.fact_orders, "fact_orders", "amount", 0),
        expectations.expect_at_least(w.dim_product, "dim_product", "selling_price", 0, strict=True),
        expectations.expect_ordered(
            w.revenue_forecast,
            "revenue_forecast",
            ["lower_bound_80pct", "predicted_revenue", "upper_bound_80pct"],
        ),
        expectations.expect_at_least(w.revenue_forecast, "revenue_forecast", "predicted_revenue", 0),
        expectations.expect_in(alerts, "alerts", "severity", rules.SEVERITIES),
        expectations.expect_in(alerts, "alerts", "rule", rules.RULES),
        expectations.expect_not_null(alerts, "alerts", ["entity", "message"]),
        expectations.expect_present(
            w.kpi_snapshot, "kpi_snapshot", "domain", ["sales", "customers", "inventory", "delivery", "marketing"]
        ),
    ]
    parts += [expectations.expect_rows(table, name) for name, table in w.gold().items()]
    parts += [
        expectations.expect_count(w.revenue_forecast, "revenue_forecast", 7),
        expectations.expect_text(_explanations(w), "anomaly_explanations", "explanation"),
    ]
    return rules.all_alerts(parts)


# --- sources as files ------------------------------------------------------------------


# compressed; a file is read by one task, which sorts its rows, so files are kept small
_CSV = {"header": True, "compression": "gzip", "maxRecordsPerFile": 100_000}


def _write_csv(
    spark: SparkSession, sf_dir: str, changed: dict[str, DataFrame] | None = None, only: list[str] | None = None
) -> str:
    """The sources as files with a header, `changed` ones in place of their source; those in
    `only`, which a query goes on to read, else all seven."""
    folder = scratch_path(spark, "csv")
    sources = dict(testtables.TestSources(spark, sf_dir)) | (changed or {})
    for name in only or sources:
        frame = sources[name]
        wanted = field_types(SOURCE_SCHEMAS[name])
        cells = [(F.col(c) if c in frame.columns else F.lit(None)).cast("string").alias(c) for c in wanted]
        frame.select(*cells).write.options(**_CSV).csv(f"{folder}/{name}.csv/1")
    return folder


# columns that tell when and from where a row was read
INGESTION = ["_ingested_at", "_source_file"]


def _again(spark: SparkSession, folder: str, name: str, frame: DataFrame) -> None:
    """A later file of a source."""
    cells = [F.col(c).cast("string").alias(c) for c in field_types(SOURCE_SCHEMAS[name])]
    frame.select(*cells).write.options(**_CSV).csv(f"{folder}/{name}.csv/2")


def _read_csv(spark: SparkSession, folder: str, kind: type[Warehouse] = Warehouse) -> Warehouse:
    return kind(files.read_sources(spark, folder, "{name}.csv/*"))


@_over_tables
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the source files that cannot be read, spoiled amounts among them."""
    orders = testtables.orders(spark, sf_dir)
    spoiled = F.when(F.expr("product_id % 101 = 9"), F.lit("12.5x")).otherwise(F.col("amount").cast("string"))
    w = _read_csv(spark, _write_csv(spark, sf_dir, {"orders": orders.withColumn("amount", spoiled)}))
    found = [quarantine.unreadable_values(name, raw) for name, raw in w.sources.items()]
    placed = F.expr("file like '%orders.csv%' and row is not null").alias("placed")
    return rules.all_alerts(found).select("source", "key", "column_name", "declared_type", "value", placed)


@_over_tables
def stg_orders_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read by name from files and staged strictly; the files hold readable times only."""
    orders = testtables.orders(spark, sf_dir).where("timestamp <> 'not-a-date'")
    w = _read_csv(spark, _write_csv(spark, sf_dir, {"orders": orders}, only=["orders"]))
    return quarantine.stage_strictly("orders", w.sources["orders"], scratch_path(spark, "quarantine"))


@_over_tables
def silver_orders_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of copies in several files the first stays, though a later one states a later time."""
    once = quality.kept_orders(testtables.orders(spark, sf_dir))
    folder = _write_csv(spark, sf_dir, {"orders": once}, only=["customers", "products", "orders"])
    # the rows as they were written: choosing one of each order again would shuffle them all
    cells = ", ".join(f"`{c}` string" for c in field_types(SOURCE_SCHEMAS["orders"]))
    written = spark.read.option("header", True).csv(f"{folder}/orders.csv/1", schema=cells)
    changes = {"timestamp": F.lit("2031-01-01 00:00:00"), "amount": F.lit(1.0)}
    _again(spark, folder, "orders", written.where("cast(quantity as int) % 3 = 0").withColumns(changes))
    return _read_csv(spark, folder, ScreenedOnce).silver("orders").drop(*INGESTION)


@_over_tables
def silver_inventory_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of copies in several files the last stays, though it states an earlier time."""
    folder = _write_csv(spark, sf_dir, only=["inventory"])
    stock = testtables.inventory(spark, sf_dir).groupBy("warehouse_id", "product_id")
    counted = stock.agg(
        F.max("available_qty").alias("available_qty"), F.min("reserved_qty").alias("reserved_qty"),
        F.max("reorder_level").alias("reorder_level"), F.lit("1990-01-01 00:00:00").alias("updated_at"),
    )
    _again(spark, folder, "inventory", counted)
    return _read_csv(spark, folder).silver("inventory").drop(*INGESTION)


# --- star schema --------------------------------------------------------------------

for _name in ("dim_customer", "dim_product", "dim_warehouse", "dim_date"):
    _over_warehouse(_name)(lambda w, n=_name: getattr(w, n))
for _name in ("fact_orders", "fact_inventory", "fact_delivery", "fact_marketing"):
    _over_warehouse(_name)(lambda w, n=_name: getattr(w, n))

_over_warehouse("dim_customer_staged")(lambda w: model.dim_customer(w.staged("customers")))
_over_warehouse("dim_product_staged")(lambda w: model.dim_product_staged(w.staged("products")))
_over_warehouse("dim_warehouse_staged")(lambda w: model.dim_warehouse(w.staged("inventory")))
_over_warehouse("dim_date_staged")(lambda w: model.dim_date_spanning(w.staged("orders")))
_over_warehouse("orders_enriched")(lambda w: w.orders_enriched)
_over_warehouse("fact_orders_staged")(lambda w: model.fact_orders_staged(w.orders_enriched))
_over_warehouse("fact_inventory_staged")(lambda w: model.fact_inventory(w.staged("inventory")))
_over_warehouse("fact_delivery_boundary_hours")(
    lambda w: model.fact_delivery_staged(w.staged("delivery"), w.staged("orders"))
)
_over_warehouse("fact_marketing_zero_default")(lambda w: model.fact_marketing_staged(w.staged("marketing")))

# --- KPIs ---------------------------------------------------------------------------

_over_warehouse("kpi_sales")(lambda w: kpis.sales_kpis(w.fact_orders))
_over_warehouse("kpi_customers")(lambda w: kpis.customer_kpis(w.fact_orders, w.dim_customer))
_over_warehouse("kpi_inventory")(lambda w: kpis.inventory_kpis(w.fact_inventory, w.fact_orders))
_over_warehouse("kpi_delivery")(lambda w: kpis.delivery_kpis(w.fact_delivery))
_over_warehouse("kpi_marketing")(lambda w: kpis.marketing_kpis(w.fact_marketing, w.fact_orders))
_over_warehouse("kpi_snapshot", ParentsOnce)(lambda w: reports.all_kpis(w.kpi_snapshot).drop("computed_at"))
_over_warehouse("kpis_of_domain", ParentsOnce)(
    lambda w: reports.kpis_by_domain(w.kpi_snapshot, "sales").drop("computed_at")
)
_over_warehouse("executive_summary", ParentsOnce)(lambda w: kpis.executive_summary(w.kpi_snapshot))


@_over_tables
def orders_on_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two calendar years, fixed, with the orders of each day."""
    orders = Warehouse.over_test_tables(spark, sf_dir).fact_orders
    daily = orders.groupBy("date_key").agg(F.count(F.lit(1)).alias("orders"))
    return model.dim_date(spark, *CALENDAR).join(daily, "date_key", "left").na.fill(0, ["orders"])


@_over_warehouse("sla_records")
def _sla_records(w: Warehouse) -> DataFrame:
    """JSON records; a day without a breach is given as not a number and written as null."""
    daily = reports.sla_trend(w.fact_delivery).select("day", "sla_breach_pct", "deliveries")
    rate = F.when(F.col("sla_breach_pct") > 0, F.col("sla_breach_pct")).otherwise(F.lit(float("nan")))
    return sinks.json_records(daily.withColumn("sla_breach_pct", rate))


@_over_warehouse("kpi_monthly_growth")
def _growth(w: Warehouse) -> DataFrame:
    return kpis.monthly_growth(kpis.monthly_sales(w.fact_orders)).select(
        "month", F.col("revenue").cast("double").alias("revenue"), "orders", "units", "growth_pct"
    )


# --- dashboard ----------------------------------------------------------------------

_over_warehouse("revenue_daily")(lambda w: reports.revenue_daily(w.fact_orders))
_over_warehouse("revenue_by_category")(lambda w: reports.revenue_by_category(w.fact_orders, w.dim_product))
_over_warehouse("revenue_by_warehouse")(lambda w: reports.revenue_by_warehouse(w.fact_orders))
_over_warehouse("recent_orders")(lambda w: reports.recent_orders(w.fact_orders))
_over_warehouse("recent_completed_orders")(lambda w: reports.recent_orders(w.fact_orders, status="completed"))
_over_warehouse("inventory_status")(lambda w: reports.inventory_status(w.fact_inventory))
_over_warehouse("at_risk_items")(lambda w: reports.at_risk_items(w.fact_inventory))
_over_warehouse("inventory_by_warehouse")(lambda w: reports.inventory_by_warehouse(w.fact_inventory))
_over_warehouse("customer_list")(lambda w: reports.list_customers(w.dim_customer))
_over_warehouse("customers_by_segment")(lambda w: reports.customers_by_segment(w.fact_orders, w.dim_customer))
_over_warehouse("top_cities")(lambda w: reports.top_cities(w.fact_orders, w.dim_customer))
_over_warehouse("partner_performance")(lambda w: reports.partner_performance(w.fact_delivery))
_over_warehouse("sla_trend")(lambda w: reports.sla_trend(w.fact_delivery))
_over_warehouse("recent_deliveries")(lambda w: reports.recent_deliveries(w.fact_delivery))
_over_warehouse("marketing_by_channel")(lambda w: reports.marketing_by_channel(w.fact_marketing))
_over_warehouse("marketing_daily")(lambda w: reports.marketing_daily(w.fact_marketing))


# --- time series --------------------------------------------------------------------

_over_warehouse("daily_panel")(lambda w: w.daily_panel)
_over_warehouse("daily_panel_by_warehouse")(
    lambda w: timeseries.daily_panel(w.fact_orders, w.fact_delivery, by=["warehouse_key"])
)
_over_warehouse("zscore_report")(lambda w: timeseries.rolling_zscore(w.daily_panel))
_over_warehouse("zscore_sensitive")(lambda w: timeseries.rolling_zscore(w.daily_panel, threshold=SENSITIVE))
_over_warehouse("zscore_prior_days")(
    lambda w: timeseries.rolling_zscore(w.daily_panel, include_current=False)
)
_over_warehouse("anomaly_drivers")(lambda w: timeseries.explain_days(w.daily_panel))
_over_warehouse("revenue_forecast")(lambda w: reports.forecast_listing(w.revenue_forecast))
# most products sell on fewer days than a forecast needs
_over_warehouse("forecast_by_product")(
    lambda w: forecast.revenue_forecast(timeseries.daily_revenue(w.fact_orders, ["product_key"]), ["product_key"])
)
_over_warehouse("forecast_stored")(
    lambda w: forecast.stamped(w.revenue_forecast, RUN_TS).withColumn("generated_at", F.expr(_PLAIN_TIME.format("generated_at")))
)
_over_warehouse("forecast_by_warehouse")(
    lambda w: forecast.revenue_forecast(timeseries.daily_revenue(w.fact_orders, ["warehouse_key"]), ["warehouse_key"])
)


@_over_warehouse("anomaly_explanations")
def _explanations(w: Warehouse) -> DataFrame:
    flagged = timeseries.rolling_zscore(w.daily_panel, threshold=SENSITIVE).withColumnRenamed(
        "is_anomaly_statistical", "is_anomaly"
    )
    return timeseries.pick_explanations(timeseries.explain_days(flagged))


def _anomaly_report(w: Warehouse) -> DataFrame:
    return timeseries.anomaly_report(w.daily_panel)


_over_warehouse("iforest_report")(lambda w: isolation.isolation_forest(w.daily_panel))
_over_warehouse("anomaly_timeline")(lambda w: reports.anomaly_timeline(_anomaly_report(w)))
_over_warehouse("flagged_anomalies")(lambda w: reports.flagged_anomalies(_anomaly_report(w)))


# --- rules --------------------------------------------------------------------------


def _live_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.running_totals(records.decode(records.encode(testtables.events(spark, sf_dir))))


def _alerts(spark: SparkSession, sf_dir: str, w: Warehouse | None = None) -> DataFrame:
    w = w or ScreenedOnce.over_test_tables(spark, sf_dir)
    return rules.all_alerts(
        [
            w.stockout_alerts,
            rules.sla_alerts(w.fact_delivery),
            rules.revenue_alerts(w.daily_revenue, w.earlier_forecast()),
            rules.payment_alerts(_live_totals(spark, sf_dir)),
        ]
    )


_over_warehouse("rule_stockout")(lambda w: w.stockout_alerts)
_over_warehouse("rule_sla")(lambda w: rules.sla_alerts(w.fact_delivery))
_over_warehouse("rule_revenue")(lambda w: rules.revenue_alerts(w.daily_revenue, w.revenue_forecast))
_over_warehouse("rule_revenue_earlier_forecast")(
    lambda w: rules.revenue_alerts(w.daily_revenue, w.earlier_forecast())
)
# a threshold below any difference, so that the last day is always reported
_over_warehouse("rule_revenue_any_difference")(
    lambda w: rules.revenue_alerts(w.daily_revenue, w.earlier_forecast(), threshold=-1e6)
)


@_over_tables
def rule_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.payment_alerts(_live_totals(spark, sf_dir))


@_over_tables
def alerts_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.list_alerts(_alerts(spark, sf_dir), status="OPEN", severity="HIGH")


@_over_tables
def alert_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.outbox(_alerts(spark, sf_dir))


@_over_tables
def alert_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running numbers given to all alerts, which must be 1..n without gaps."""
    ids = rules.numbered(_alerts(spark, sf_dir))
    return ids.select(F.split_part("alert_id", F.lit("-"), F.lit(2)).cast("bigint").alias("number"), "notified")


@_over_tables
def alerts_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts as they are stored by a run; the running number in the id is blanked out."""
    found = rules.numbered(_alerts(spark, sf_dir), RUN_TS)
    return found.withColumns(
        {
            "alert_id": F.regexp_replace("alert_id", r"(?<=^ALRT-)\d{5,}(?=-)", "n"),
            "created_at": F.expr(_PLAIN_TIME.format("created_at")),
        }
    )


def _status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock movements as status changes of the stockout alert of the same item."""
    movement = testtables.events(spark, sf_dir).filter(F.col("event_type") == "inventory_adjustment")
    status = (
        F.when(F.col("event_id") % 10 == 0, "IGNORED")
        .when(F.col("delta_qty") < 0, "ACKNOWLEDGED")
        .otherwise("RESOLVED")
    )
    return movement.select(
        F.concat_ws(":", "warehouse_id", F.col("product_id").cast("string")).alias("alert_id"),
        status.alias("status"),
        F.col("event_ts").alias("changed_at"),
    )


@_over_tables
def alert_current_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_alerts = Warehouse.over_test_tables(spark, sf_dir).stockout_alerts.withColumn("alert_id", F.col("entity"))
    return rules.current_status(open_alerts, _status_events(spark, sf_dir)).select("alert_id", "rule", "status")


@_over_tables
def alert_status_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_alerts = Warehouse.over_test_tables(spark, sf_dir).stockout_alerts.withColumn("alert_id", F.col("entity"))
    return rules.split_status_events(_status_events(spark, sf_dir), open_alerts)[1]


@_over_tables
def operations_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ScreenedOnce.over_test_tables(spark, sf_dir)
    return reports.operations_summary(w.fact_inventory, w.fact_delivery, _alerts(spark, sf_dir, w))


# --- live feed ----------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of JSON records, decoded."""
    rows = (
        spark.readStream.schema(testtables.table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", 100)
        .parquet(sf_dir)
    )
    return records.decode(records.encode(testtables.shape_events(rows)))


@_over_tables
def live_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs the totals stream until the input is used up and reads its table."""
    path = scratch_path(spark, "live-metrics")
    live.start_totals(_event_stream(spark, sf_dir), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return reports.live_metrics(live.read_totals(spark, f"{path}/table")).drop("updated_at")


@_over_tables
def live_orders_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs the raw-event stream until the input is used up and lists the latest orders."""
    path = scratch_path(spark, "live-events")
    live.start_event_tables(_event_stream(spark, sf_dir), f"{path}/tables", f"{path}/checkpoint").awaitTermination()
    return reports.recent_live_orders(live.read_events(spark, f"{path}/tables", "order_created"))


@_over_tables
def live_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of the live feed computed in batch."""
    return _live_totals(spark, sf_dir)


@_over_tables
def live_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.route_counts(records.decode(records.encode(testtables.events(spark, sf_dir))))


# records of one file of the feed below
_FILE_RECORDS = 1_000_000


def _feed(spark: SparkSession, sf_dir: str, folder: str, repeated: bool = False) -> None:
    """The events as files of JSON records in the order of event time, four at least. With
    `repeated` every fifth event comes twice, and some of the first file again in the last."""
    events = testtables.events(spark, sf_dir)
    count = events.agg(F.coalesce(F.max("event_id") + 1, F.lit(1))).first()[0]
    files = max(4, -(-count // _FILE_RECORDS))
    # dealt by file once: each file is then written from its own rows, not from the whole table
    dealt = events.withColumn("file_number", F.expr(f"event_id * {files} div {count}"))
    dealt.repartition(files, "file_number").write.partitionBy("file_number").parquet(f"{folder}-dealt")

    rows = spark.read.schema(dealt.schema).parquet(f"{folder}-dealt")

    for number in range(files):
        own = rows.where(F.col("file_number") == number).drop("file_number")
        if repeated:
            own = own.unionByName(own.where("event_id % 5 = 0"))
            if number == files - 1:
                own = own.unionByName(rows.where("file_number = 0 and event_id % 7 = 0").drop("file_number"))
        records.encode(own).coalesce(1).write.mode("append").json(folder)


def _by_file(spark: SparkSession, folder: str) -> DataFrame:
    return records.decode(records.file_records(spark, folder, max_files=1))


@_over_tables
def live_totals_over_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals stream in batches of one file, stopped after a batch and continued."""
    path = scratch_path(spark, "live-restart")
    _feed(spark, sf_dir, f"{path}/feed")

    def start(interval: str | None = None):
        return live.start_totals(_by_file(spark, f"{path}/feed"), f"{path}/table", f"{path}/checkpoint", interval)

    first = start("1 second")
    while first.isActive and not any(p["numInputRows"] for p in first.recentProgress):
        time.sleep(0.1)
    first.stop()
    start().awaitTermination()
    return reports.live_metrics(live.read_totals(spark, f"{path}/table")).drop("updated_at")


@_over_tables
def live_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per batch of the totals stream, from the table of its progress."""
    path = scratch_path(spark, "live-progress")
    _feed(spark, sf_dir, f"{path}/feed")
    with ProgressTable(spark, f"{path}/progress") as progress:
        live.start_totals(_by_file(spark, f"{path}/feed"), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return progress.read().select("batch_id", "input_rows", "late_rows")


@_over_tables
def live_revenue_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed hours of event time over a feed that repeats events, at once and much later."""
    path = scratch_path(spark, "live-hours")
    _feed(spark, sf_dir, f"{path}/feed", repeated=True)
    live.start_revenue_by_hour(_by_file(spark, f"{path}/feed"), f"{path}/hours", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema("hour timestamp_ntz, revenue double, orders bigint").parquet(f"{path}/hours")


def _compacted(spark: SparkSession, sf_dir: str) -> str:
    """Event tables written in several batches, the closed ones compacted and removed."""
    path = scratch_path(spark, "live-tables")
    _feed(spark, sf_dir, f"{path}/feed")
    live.start_event_tables(_by_file(spark, f"{path}/feed"), f"{path}/tables", f"{path}/checkpoint").awaitTermination()
    compaction.compact(spark, f"{path}/tables")
    compaction.clean(spark, f"{path}/tables", older_than=0)
    return f"{path}/tables"


def _register_table(name: str, event_type: str) -> None:
    _QUERIES[name] = lambda spark, sf_dir: live.read_events(spark, _compacted(spark, sf_dir), event_type)


_register_table("live_payments", "payment_processed")
_register_table("live_deliveries", "delivery_update")
_register_table("live_stock_movements", "inventory_adjustment")
