"""The batch run: all stages in order in one session, each reading what the one before stored.

    python -m marketlens.plans.batch <folder with the source files> <output folder>

A stage that fails stops the run; the next one goes on there if the source files are the
same (`plans.ledger`). Every stage replaces its tables, the alert history the part of the
run, so a run can be repeated, and each stage can be run alone on stored input.
"""

from __future__ import annotations

import logging
import sys
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators import expectations, forecast, model, quality, rules, staging, timeseries
from marketlens.operators.lookup import input_bytes
from marketlens.plans.ledger import Ledger, fingerprint
from marketlens.plans.warehouse import Warehouse
from marketlens.session import build_session, size_shuffles
from marketlens.sources.files import path_exists, read_sources
from marketlens.sources.schemas import ALERTS
from marketlens.sources.sinks import ensure_table, replace_table

log = logging.getLogger(__name__)

GOLD_TABLES = [
    "dim_customer",
    "dim_product",
    "dim_warehouse",
    "dim_date",
    "fact_orders",
    "fact_inventory",
    "fact_delivery",
    "fact_marketing",
]
MONTH = "order_month"


class BatchRun:
    def __init__(self, spark: SparkSession, out_dir: str, run_ts: datetime | None = None):
        self.spark = spark
        self.out_dir = out_dir.rstrip("/")
        self.run_ts = run_ts or datetime.now(timezone.utc)

    def path(self, layer: str, name: str) -> str:
        return f"{self.out_dir}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def replace(self, df: DataFrame, layer: str, name: str, partition_by: list[str] | None = None) -> None:
        replace_table(df, self.path(layer, name), partition_by)
        log.info("stored %s.%s", layer, name)

    # --- stages ---------------------------------------------------------------------

    def bronze(self, sources: Mapping[str, DataFrame]) -> None:
        """Stores the sources as read."""
        for name in sources:
            self.replace(sources[name], "bronze", name)

    def silver(self) -> None:
        """Screened rows are stored once, split into accepted and refused; the quality report
        is counted by that write."""
        names = [n for n in quality.SOURCES if path_exists(self.spark, self.path("bronze", n))]
        raw = {name: self.read("bronze", name) for name in names}

        def store(name: str, screened: DataFrame) -> DataFrame:
            marked = screened.withColumn("accepted", F.col(quality.REASON).isNull().cast("int"))
            self.replace(marked, "silver", name, ["accepted"])
            return self.read("silver", name).drop("accepted")

        self.replace(quality.store_screened(raw, store)[1], "silver", "dq_report")
        counts = reduce(DataFrame.unionByName, [quality.unreadable(name, raw[name]) for name in names])
        self.replace(counts, "silver", "unreadable_numbers")

    def accepted(self, name: str) -> DataFrame:
        """Accepted rows of a stored source; the refused ones are pruned as a partition."""
        rows = self.read("silver", name).filter("accepted = 1")
        return rows.drop("accepted", quality.REASON)

    def gold(self) -> None:
        """Stores the star schema; its declared checks become `gold_checks`."""
        warehouse = _SilverStored(self)

        def store(name: str, df: DataFrame) -> DataFrame:
            if name == "fact_orders":
                # balanced files per month: small months are merged, large ones split
                by_month = df.withColumn(MONTH, F.expr("cast(date_key div 100 as int)"))
                self.replace(by_month.hint("rebalance", MONTH), "gold", name, [MONTH])
            else:
                self.replace(df, "gold", name)
            return self.read("gold", name)

        checks = expectations.store_checked({n: getattr(warehouse, n) for n in GOLD_TABLES}, store)[1]
        self.replace(checks, "serving", "gold_checks")

    def stored_gold(self) -> Warehouse:
        return Warehouse.over_stored({n: self.read("gold", n).drop(MONTH) for n in GOLD_TABLES})

    def staged_marts(self, strict: bool = True) -> None:
        """The staged variant of the star schema from the stored bronze tables. Staging is
        stored once, since several marts read it."""
        stg = {}
        for name in quality.SOURCES:
            if name != "support":
                self.replace(getattr(staging, f"stg_{name}")(self.read("bronze", name), strict=strict), "staging", name)
                stg[name] = self.read("staging", name)
        enriched = model.orders_enriched(stg["orders"], stg["products"], stg["customers"])
        marts = {
            "dim_customer": model.dim_customer(stg["customers"]),
            "dim_product": model.dim_product_staged(stg["products"]),
            "dim_warehouse": model.dim_warehouse(stg["inventory"]),
            "dim_date": model.dim_date_spanning(stg["orders"]),
            "fact_orders": model.fact_orders_staged(enriched),
            "fact_inventory": model.fact_inventory(stg["inventory"]),
            "fact_delivery": model.fact_delivery_staged(stg["delivery"], stg["orders"]),
            "fact_marketing": model.fact_marketing_staged(stg["marketing"]),
        }
        for name, df in marts.items():
            self.replace(df, "marts", name)

    def mart_checks(self) -> DataFrame:
        """The declared checks over the stored marts."""
        return expectations.schema_checks({name: self.read("marts", name) for name in GOLD_TABLES})

    def kpis(self) -> None:
        self.replace(self.stored_gold().kpi_snapshot, "serving", "kpi_snapshot")

    def anomalies(self) -> None:
        report = timeseries.anomaly_report(self.stored_gold().daily_panel)
        self.replace(report.withColumn("computed_at", F.lit(self.run_ts)), "serving", "anomaly_report")
        explained = timeseries.explain_days(self.read("serving", "anomaly_report"))
        self.replace(timeseries.pick_explanations(explained), "serving", "anomaly_explanations")

    def forecast(self) -> None:
        rows = forecast.stamped(self.stored_gold().revenue_forecast)
        self.replace(rows, "serving", "revenue_forecast")

    def alerts(self, live_metrics: DataFrame | None = None) -> None:
        """The run's alerts become its part of the history, replacing what an earlier attempt
        of the same run left; their messages go to the outbox of the run."""
        gold = self.stored_gold()
        found = [
            gold.stockout_alerts,
            rules.sla_alerts(gold.fact_delivery),
            rules.revenue_alerts(gold.daily_revenue, self.read("serving", "revenue_forecast")),
        ]
        if live_metrics is not None:
            found.append(rules.payment_alerts(live_metrics))
        self.replace(rules.numbered(rules.all_alerts(found), self.run_ts), "serving", "new_alerts")
        new = self.read("serving", "new_alerts")
        ensure_table(self.spark, self.path("serving", "alerts"), ALERTS)
        replace_table(new, f"{self.path('serving', 'alerts')}/run={int(self.run_ts.timestamp())}")
        self.replace(rules.outbox(new), "serving", "alert_outbox")


class _SilverStored(Warehouse):
    """Gold frames over the stored silver tables."""

    def __init__(self, run: BatchRun):
        super().__init__({})
        self._run = run

    def silver(self, name: str) -> DataFrame:
        return self._run.accepted(name)

    @cached_property
    def fact_delivery(self) -> DataFrame:
        return model.fact_delivery(self.silver("delivery"), self.silver("orders"))


def run_all(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    out_dir: str,
    run_ts: datetime | None = None,
    live_metrics: DataFrame | None = None,
    resume: bool = False,
) -> BatchRun:
    """Bronze, silver, gold, KPIs, anomalies, forecast, alerts.

    With `resume` stages that were finished on the same source files are skipped. Those that
    stamp their rows count as finished for the same `run_ts` only, and alerts that look at
    live metrics never do.
    """
    run = BatchRun(spark, out_dir, run_ts)
    size_shuffles(spark, sum(input_bytes(sources[name]) for name in sources))
    stamp, live = run.run_ts.isoformat(), "" if live_metrics is None else uuid.uuid4().hex
    stages = [
        ("bronze", "", lambda: run.bronze(sources)),
        ("silver", "", run.silver),
        ("gold", "", run.gold),
        ("kpis", "", run.kpis),
        ("anomalies", stamp, run.anomalies),
        ("forecast", "", run.forecast),
        ("alerts", stamp + live, lambda: run.alerts(live_metrics)),
    ]
    start = fingerprint(spark, sources) if resume else uuid.uuid4().hex
    done = Ledger(spark, f"{run.out_dir}/_ledger").run(start, stages)
    log.info("ran %s", ", ".join(done) or "nothing")
    return run


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    session = build_session("batch run")
    run_all(session, read_sources(session, sys.argv[1]), sys.argv[2], resume=True)
