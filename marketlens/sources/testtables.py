"""The seven sources and the event feed as views over the supplied test tables.

The mapping follows FIXTURES.md section 3. It injects nulls, orphans, malformed
times and negative amounts by modulus, so that every quality rule has work to do.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns of the supplied tables. Declared, so that opening a table
# starts no job to read its footer.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_WAREHOUSE = "'WH0' || cast(l_suppkey % 6 + 1 as string) as warehouse_id"
_ORDER_ID = "'O' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as order_id"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "c_custkey as customer_id",
            "n_name as city",
            "r_name as state",
            "c_mktsegment as segment",
            "date_add(date '2000-01-01', cast(c_custkey % 700 as int)) as registration_date",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as product_id",
        "p_type as category",
        "p_brand as brand",
        "p_retailprice - 300 - (p_partkey % 97) as cost",
        "if(p_partkey % 211 = 5, 0D, p_retailprice) as selling_price",
        "'S' || cast(p_partkey % 40 as string) as supplier_id",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # reduced to what is asked of them before the join, which shuffles both tables when they are large
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey % 6 as _supplier",
        "cast(l_shipdate as date) as _shipped",
        "cast(l_quantity as int) as quantity",
        "l_extendedprice",
        "l_returnflag = 'R' as _returned",
    )
    heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return items.join(heads, F.expr("l_orderkey = o_orderkey")).selectExpr(
        _ORDER_ID,
        """case when l_orderkey % 97 = 3 then null
                when l_orderkey % 89 = 4 then -1L else o_custkey end as customer_id""",
        "l_partkey as product_id",
        "'WH0' || cast(_supplier + 1 as string) as warehouse_id",
        """if(l_partkey % 83 = 6, 'not-a-date',
              cast(_shipped as string) || ' 00:00:00') as timestamp""",
        "quantity",
        "if(l_orderkey % 79 = 7, -l_extendedprice, l_extendedprice) as amount",
        """case when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then 'pending'
                when _returned then 'returned' else 'cancelled' end as status""",
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        _WAREHOUSE,
        "l_partkey as product_id",
        "cast(l_quantity as int) * 3 - 6 as available_qty",
        "l_linenumber * 5 as reserved_qty",
        "cast(20 + l_partkey % 81 as int) as reorder_level",
        "l_shipdate as updated_at",
    )


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .filter("l_orderkey % 10 <> 0")
        .selectExpr(
            _ORDER_ID,
            "'partner_' || cast(l_suppkey % 5 as string) as partner",
            "l_shipdate + make_dt_interval(0, cast(l_orderkey % 24 as int)) as pickup_time",
            """l_shipdate + make_dt_interval(0, cast(l_orderkey % 24 + 24 * (1 + l_partkey % 5) as int))
               as expected_delivery""",
            "cast((l_orderkey * 7 + l_partkey) % 60 - 48 as int) as late_hours",
            "if(l_orderkey % 14 = 0, 'in_transit', 'delivered') as status",
        )
        .selectExpr(
            "order_id",
            "partner",
            "pickup_time",
            "expected_delivery",
            "expected_delivery + make_dt_interval(0, late_hours) as actual_delivery",
            "status",
        )
    )


def support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter("event_type = 'error'")
        .selectExpr(
            "'T' || cast(event_id as string) as ticket_id",
            "user_id as customer_id",
            "event_id % 6 as issue_type",
            "event_id % 4 as priority",
            "ts as created_at",
            "if(event_id % 7 = 0, null, ts + make_dt_interval(0, cast(1 + event_id % 120 as int))) as resolved_at",
        )
    )


def marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.expr("cast(ts as date) as date"), F.expr("'ch_' || cast(user_id % 6 as string) as channel"))
        .agg(
            F.expr("cast(sum(if(event_type = 'click', cast(value as decimal(18,2)), 0)) as double) as spend"),
            F.expr("cast(count_if(event_id % 5 <> 0) as int) as impressions"),
            F.expr("cast(count_if(event_type = 'click' and event_id % 5 = 1) as int) as clicks"),
            F.expr("cast(count_if(event_type = 'purchase' and event_id % 5 = 2) as int) as conversions"),
        )
        .selectExpr(
            "'CMP_' || channel || '_' || cast(year(date) * 100 + month(date) as string) as campaign_id",
            "date",
            "channel",
            "spend",
            "impressions",
            "clicks",
            "conversions",
        )
    )


def shape_events(rows: DataFrame) -> DataFrame:
    """Rows of the events table (batch or stream) as business events, one wide row each."""
    return rows.selectExpr(
        "event_id",
        """case event_type when 'purchase' then 'order_created' when 'click' then 'payment_processed'
                when 'view' then 'delivery_update' when 'signup' then 'inventory_adjustment'
                else 'unknown' end as event_type""",
        "'EV' || cast(event_id as string) as order_id",
        "user_id as customer_id",
        "event_id % 200 as product_id",
        "'WH0' || cast(user_id % 6 + 1 as string) as warehouse_id",
        "cast(1 + event_id % 4 as int) as quantity",
        "value as amount",
        "if(event_id % 17 = 0, 'cancelled', 'completed') as status",
        "if(event_id % 12 = 0, 'failed', 'success') as result",
        "'partner_' || cast(event_id % 5 as string) as partner",
        "event_id % 8 = 0 as sla_breach",
        "cast(event_id % 21 - 15 as int) as delta_qty",
        "ts as event_ts",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(table(spark, sf_dir, "events"))


class TestSources(Mapping):
    """The seven sources by name, each built when first asked for."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        builders = (orders, customers, products, inventory, delivery, support, marketing)
        self._builders = {build.__name__: build for build in builders}
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self._spark, self._sf_dir)
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
