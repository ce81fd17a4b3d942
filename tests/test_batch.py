"""The batch run over source files, and what must hold for the stored tables."""

import shutil
from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketlens.functions.columns import money_sum
from marketlens.operators import expectations, kpis, quality, reports, rules, staging
from marketlens.plans.batch import GOLD_TABLES, BatchRun, run_all
from marketlens.sources import testtables
from marketlens.sources.files import read_source, read_sources, register_views
from marketlens.sources.schemas import ALERTS, SOURCE_SCHEMAS, field_types
from marketlens.sources.sinks import ensure_table, save_as_table
from marketlens.streaming import live

RUN_TS = datetime(2025, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def csv_folder(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("csv"))
    sources = testtables.TestSources(spark, sf_dir)
    for name in sources:
        columns = [c for c in field_types(SOURCE_SCHEMAS[name]) if c in sources[name].columns]
        text = sources[name].select(columns)
        if name == "support":
            text = text.withColumn("order_id", F.lit(None).cast("string")).select(*field_types(SOURCE_SCHEMAS[name]))
        writer = text.coalesce(1).write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        writer.csv(f"{folder}/{name}.csv", header=True)
    return folder


@pytest.fixture(scope="module")
def run(spark, sf_dir, csv_folder, tmp_path_factory):
    totals = live.running_totals(testtables.events(spark, sf_dir))
    out = str(tmp_path_factory.mktemp("out"))
    return run_all(spark, read_sources(spark, csv_folder), out, RUN_TS, totals)


def failures(df):
    return {(r["table_name"], r["column_name"], r["check_name"]): r["failures"] for r in df.collect() if r["failures"]}


@pytest.mark.parametrize("name", sorted(SOURCE_SCHEMAS))
def test_bronze_keeps_every_row_with_metadata(spark, sf_dir, run, name):
    bronze = run.read("bronze", name)
    assert bronze.count() == testtables.TestSources(spark, sf_dir)[name].count()
    row = bronze.select("_ingested_at", "_source_file").distinct().collect()
    assert len(row) == 1
    assert row[0]["_source_file"].endswith(".csv")


def test_silver_keys_are_complete_and_unique(run):
    keys = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "delivery": "order_id"}
    for name, key in keys.items():
        rows = run.accepted(name)
        assert rows.count() > 0
        assert failures(expectations.expect_not_null(rows, name, [key])) == {}
        assert failures(expectations.expect_unique(rows, name, key)) == {}
    assert run.read("silver", "dq_report").count() == 13


def test_gold_meets_the_declared_checks(run):
    tables = {name: run.read("gold", name) for name in GOLD_TABLES}
    assert all(df.count() > 0 for df in tables.values())
    report = expectations.schema_checks(tables)
    assert report.count() == 20
    assert failures(report) == {}
    assert failures(expectations.expect_at_least(tables["fact_orders"], "fact_orders", "amount", 0)) == {}


def test_fact_orders_is_partitioned_by_month(run):
    plan = run.read("gold", "fact_orders").filter("order_month = 199801")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


def test_staged_marts_are_stored_and_checked(run):
    run.staged_marts(strict=False)
    assert all(run.read("marts", name).count() > 0 for name in GOLD_TABLES)
    # staging refers to nothing, so orders without a customer stay and are reported
    assert set(failures(run.mart_checks())) == {
        ("fact_orders", "customer_key", "not_null"),
        ("fact_orders", "customer_key", "relationships"),
        ("fact_orders", "product_key", "relationships"),
    }


def test_kpis_cover_all_domains(run):
    snapshot = run.read("serving", "kpi_snapshot")
    domains = ["sales", "customers", "inventory", "delivery", "marketing"]
    assert failures(expectations.expect_present(snapshot, "kpi_snapshot", "domain", domains)) == {}
    summary = kpis.executive_summary(snapshot).first()
    assert summary["total_revenue"] > 0
    assert reports.all_kpis(snapshot).count() >= 23


def test_anomalies_and_forecast_are_stored(run):
    report = run.read("serving", "anomaly_report")
    assert {"is_anomaly_statistical", "is_anomaly_iforest", "is_anomaly", "computed_at"} <= set(report.columns)
    explained = run.read("serving", "anomaly_explanations").collect()
    assert 0 < len(explained) <= 3
    assert all(r["explanation"] for r in explained)
    ahead = run.read("serving", "revenue_forecast")
    assert ahead.count() == 7
    bounds = ["lower_bound_80pct", "predicted_revenue", "upper_bound_80pct"]
    assert failures(expectations.expect_ordered(ahead, "forecast", bounds)) == {}


def test_alerts_accumulate_by_run_and_use_known_values(spark, run):
    alerts = run.read("serving", "alerts")
    before = alerts.count()
    assert before > 0
    assert failures(expectations.expect_in(alerts, "alerts", "severity", rules.SEVERITIES)) == {}
    assert failures(expectations.expect_in(alerts, "alerts", "rule", rules.RULES)) == {}
    assert {r[0] for r in alerts.select("rule").distinct().collect()} >= {"payment_failure_rate", "delivery_sla_breach"}
    run.alerts()
    repeated = run.read("serving", "alerts").count()
    run.alerts()
    assert run.read("serving", "alerts").count() == repeated
    later = BatchRun(spark, run.out_dir, RUN_TS + timedelta(days=1))
    later.alerts()
    assert run.read("serving", "alerts").count() == 2 * repeated


def test_columns_are_found_by_name_and_quotes_are_doubled(spark, folder):
    text = 'brand,supplier_id,product_id,category,selling_price,cost,extra\n"say ""hi"", all",S1,P1,c,12.5x,7.25,z\n'
    (Path(folder).mkdir(), (Path(folder) / "products.csv").write_text(text))
    raw = read_source(spark, "products", f"{folder}/products.csv")
    row = raw.first()
    assert (row["brand"], row["category"], row["cost"], row["selling_price"]) == ('say "hi", all', "c", "7.25", "12.5x")
    found = {(r["column_name"], r["unreadable"]) for r in quality.unreadable("products", raw).collect()}
    assert found == {("cost", 0), ("selling_price", 1)}
    assert quality.screen_products(raw).first()[quality.REASON] == quality.MISSING_PRICE
    with pytest.raises(Exception, match="12.5x"):
        staging.stg_products(raw).collect()
    (Path(folder) / "products.csv").write_text("product_id,cost\nP1,2\n")
    with pytest.raises(ValueError, match="category"):
        read_source(spark, "products", f"{folder}/products.csv")


def test_values_below_a_cent_are_added_whole(spark):
    rows = spark.range(1000).selectExpr("0.0004D as amount")
    assert rows.agg(money_sum("amount")).first()[0] == 0.4


def test_missing_source_is_skipped(spark, csv_folder, folder):
    columns = list(field_types(SOURCE_SCHEMAS["support"]))
    read_source(spark, "support", f"{csv_folder}/support.csv").select(columns).write.csv(f"{folder}/support.csv", header=True)
    assert set(read_sources(spark, folder)) == {"support"}


def test_file_order_decides_between_copies(spark, folder):
    rows = [("T1", str(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "ticket_id string, customer_id string").coalesce(1)
    full = df.selectExpr("*", *[f"cast(null as string) as {c}" for c in list(field_types(SOURCE_SCHEMAS["support"]))[2:]])
    full.write.csv(f"{folder}/support.csv", header=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        from marketlens.operators import quality

        raw = read_source(spark, "support", f"{folder}/support.csv")
        assert raw.rdd.getNumPartitions() > 1
        assert quality.accepted(quality.screen_support(raw)).first()["customer_id"] == "0"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_views_and_tables(spark, run, folder):
    register_views({"orders": run.accepted("orders")}, prefix="silver_")
    assert spark.sql("select count(*) from silver_orders").first()[0] == run.accepted("orders").count()
    save_as_table(run.read("gold", "dim_product"), "dim_product_bucketed", bucket_by="product_key", buckets=4)
    assert spark.table("dim_product_bucketed").count() == run.read("gold", "dim_product").count()
    empty = ensure_table(spark, f"{folder}/alerts", ALERTS)
    assert empty.count() == 0
    assert empty.columns[0] == "alert_id"


def test_a_run_that_stopped_goes_on(spark, csv_folder, run, tmp_path, monkeypatch):
    out, copy = str(tmp_path / "out"), str(tmp_path / "csv")
    shutil.copytree(csv_folder, copy)

    def again():
        return run_all(spark, read_sources(spark, copy), out, RUN_TS, resume=True)

    def written(folder):
        return {str(f): f.stat().st_mtime_ns for f in Path(folder).rglob("*.parquet")}

    def stop(self):
        raise RuntimeError("power cut")

    with monkeypatch.context() as patch:
        patch.setattr(BatchRun, "kpis", stop)
        with pytest.raises(RuntimeError, match="power cut"):
            again()
    before = written(f"{out}/gold")
    assert before and not Path(out, "serving/kpi_snapshot").exists()
    resumed = again()
    assert written(f"{out}/gold") == before  # not written again
    for layer, names in (("gold", GOLD_TABLES), ("serving", ["anomaly_report", "gold_checks"])):
        for name in names:
            # when and from which file a row was read differs
            columns = [c for c in run.read(layer, name).columns if not c.startswith("_")]
            found, whole = (Counter(map(str, r.read(layer, name).select(columns).collect())) for r in (resumed, run))
            assert found == whole, name
    # nothing is left to do, until the files of a source change
    everything = written(out)
    again()
    assert written(out) == everything
    Path(copy, "support.csv", "more.csv").write_text(Path(next(Path(copy, "support.csv").glob("part*"))).read_text().splitlines()[0] + "\n")
    ran = []
    for stage in ("bronze", "silver", "gold", "kpis", "anomalies", "forecast", "alerts"):
        monkeypatch.setattr(BatchRun, stage, lambda self, *_, stage=stage: ran.append(stage))
    again()
    assert ran == ["bronze", "silver", "gold", "kpis", "anomalies", "forecast", "alerts"]
