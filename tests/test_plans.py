"""Plans that must hold at scale: pruning, pushdown, size-checked broadcasts, skew."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from marketlens.operators import kpis, model, quality, reports
from marketlens.plans.warehouse import Warehouse


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


@pytest.fixture
def conf(spark):
    changed = []

    def set_to(key, value):
        changed.append((key, spark.conf.get(key, None)))
        spark.conf.set(key, value)

    yield set_to
    for key, value in reversed(changed):
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def stored_facts(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("facts"))
    w = Warehouse.over_test_tables(spark, sf_dir)
    for name in ("fact_orders", "dim_product", "dim_customer"):
        getattr(w, name).write.parquet(f"{folder}/{name}")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in ("fact_orders", "dim_product", "dim_customer")}


def test_report_reads_only_its_columns_and_pushes_its_filter(stored_facts):
    plan = executed(reports.revenue_by_warehouse(stored_facts["fact_orders"]))
    assert "EqualTo(status,completed)" in plan
    assert "ReadSchema: struct<warehouse_key:string,amount:double,status:string>" in plan


def test_recent_demand_filters_the_scan_by_subquery(stored_facts):
    from marketlens.operators.rules import recent_demand

    plan = executed(recent_demand(stored_facts["fact_orders"]))
    assert "Subquery" in plan
    assert "Join" not in plan


def test_top_k_is_not_a_full_sort(stored_facts):
    assert "TakeOrderedAndProject" in executed(reports.recent_orders(stored_facts["fact_orders"]))


def test_shared_layers_are_computed_once(spark, sf_dir):
    plan = executed(queries()["kpi_snapshot"](spark, sf_dir))
    scans = re.findall(r"FileScan parquet.*?lineitem", plan)
    assert len(scans) == 3  # orders, inventory and delivery
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_no_query_multiplies_rows(spark, sf_dir):
    for name in ("operations_summary", "alert_outbox", "anomaly_explanations", "kpi_marketing", "rule_stockout"):
        plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_lookup_side_beyond_the_limit_is_shuffled_with_the_same_result(spark, sf_dir, conf):
    w = Warehouse.over_test_tables(spark, sf_dir)
    expected = sorted(map(tuple, w.fact_orders.collect()))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    facts = Warehouse.over_test_tables(spark, sf_dir).fact_orders
    assert sorted(map(tuple, facts.collect())) == expected
    assert "BroadcastHashJoin" not in executed(facts)


def hot_orders(spark):
    """Every third order is of product 0, and every third of customer -1 or none."""
    return spark.range(300_000, numPartitions=8).selectExpr(
        "cast(id as string) as order_id", "if(id % 3 = 1, if(id % 2 = 0, null, -1), id % 7000) as customer_id",
        "if(id % 3 = 0, 0, id % 5000) as product_id", "'W' as warehouse_id",
        "timestamp_ntz '2025-01-01 00:00:00' as timestamp", "1 as quantity", "1D as amount", "'completed' as status",
    )


def without_broadcasts(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64kb")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64kb")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")


def test_hot_keys_are_split_in_the_whole_chain(spark, conf):
    without_broadcasts(conf)
    products = spark.range(5000).selectExpr("id as product_id", "0.5D as cost", "'c' as category", "'b' as brand")
    customers = spark.range(7000).selectExpr("id as customer_id", "'x' as city", "'y' as state", "'z' as segment")
    screened = quality.accepted(quality.screen_orders(hot_orders(spark), customers, products))
    by_product = model.fact_orders(screened, products).groupBy("product_key").agg(F.sum("cost_total").alias("cost"))
    plan = executed(by_product)
    assert plan.count("skew=true") >= 2
    # a third of all, and twenty of the others
    assert by_product.filter("product_key = 0").first()["cost"] == 50_010.0


def test_hot_key_of_a_large_lookup_is_split(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64kb")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64kb")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    rows = spark.range(300_000, numPartitions=8)
    # every third order is of product 0
    orders = rows.selectExpr(
        "id as order_id", "id as customer_id", "if(id % 3 = 0, 0, id % 5000) as product_id", "'W' as warehouse_id",
        "timestamp_ntz '2025-01-01 00:00:00' as timestamp", "1 as quantity", "1D as amount", "'completed' as status",
    )
    products = spark.range(5000).selectExpr("id as product_id", "0.5D as cost")
    facts = model.fact_orders(orders, products)
    plan = executed(facts.groupBy("quantity").agg(F.sum("cost_total").alias("cost"), F.count(F.lit(1)).alias("n")))
    assert "skew=true" in plan
    assert facts.agg(F.sum("cost_total")).first()[0] == 150_000.0


def test_one_key_with_a_third_of_all_rows_leaves_each_map_task_once(spark):
    rows = spark.range(100_000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) as ticket_id", "id as created_at"
    )
    screened = quality.screen_support(rows)
    assert screened.filter("ticket_id = 'hot'").first()["created_at"] == 99_999
    plan = executed(screened)
    below_shuffle = plan[plan.index("Exchange hashpartitioning(ticket_id") :]
    assert "row_number(), 1, Partial" in below_shuffle


def test_every_deduplication_is_cut_before_its_shuffle(spark, sf_dir):
    w = Warehouse.over_test_tables(spark, sf_dir)
    # the marketing rows of the test tables come out of an aggregate on the same keys
    for name in sorted(set(quality.SOURCES) - {"marketing"}):
        for df in (w.silver(name), w.staged(name)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("row_number(), 1, Partial") == plan.count("Window [row_number()") > 0, name


def test_delivery_join_needs_no_shuffle_of_its_own(spark, sf_dir, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    plan = executed(Warehouse.over_test_tables(spark, sf_dir).fact_delivery)
    assert plan.count("Exchange hashpartitioning(order_id") == 2
    assert "SortMergeJoin [order_id" in plan


def test_customers_are_counted_without_a_second_shuffle_of_orders(stored_facts):
    df = reports.customers_by_segment(stored_facts["fact_orders"], stored_facts["dim_customer"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "count(distinct" not in plan.lower()


def test_sales_figures_scan_orders_once(stored_facts):
    plan = executed(kpis.sales_kpis(stored_facts["fact_orders"]))
    assert plan.count("FileScan") == 1
