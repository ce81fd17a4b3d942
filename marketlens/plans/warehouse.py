"""All layers as frames that are composed on first use."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators import forecast, kpis, model, quality, rules, staging, timeseries
from marketlens.operators.lookup import one_per_key, small_side
from marketlens.session import stored
from marketlens.sources import testtables

# products with their unit cost, 16 bytes each; beyond this orders are shuffled by product
BROADCAST_PRODUCTS = 2_000_000
# ids of customers or products, 8 bytes each; beyond this orders are shuffled by them
BROADCAST_PARENTS = 2_000_000


class Warehouse:
    """Silver, gold and derived frames over seven source frames.

    Nothing runs until a frame is used. A layer that several frames share has the same
    plan in each, so its shuffle is computed once within a query (exchange reuse);
    separate jobs should read stored layers, see `plans.batch`.
    """

    def __init__(self, sources: Mapping[str, DataFrame]):
        self.sources = sources
        self._screened: dict[str, DataFrame] = {}

    @classmethod
    def over_test_tables(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        return cls(testtables.TestSources(spark, sf_dir))

    @classmethod
    def over_stored(cls, gold: Mapping[str, DataFrame]) -> Warehouse:
        """Derived frames over gold tables that are already stored."""
        warehouse = cls({})
        # a cached property that is already set is not computed
        warehouse.__dict__.update(gold)
        return warehouse

    # --- silver ---------------------------------------------------------------------

    def screened(self, name: str) -> DataFrame:
        """One row per key with its reject reason, see `operators.quality`."""
        if name not in self._screened:
            screen = getattr(quality, f"screen_{name}")
            parents = self.parents() if name == "orders" else []
            self._screened[name] = screen(self.sources[name], *parents)
        return self._screened[name]

    def parents(self) -> tuple[DataFrame, DataFrame]:
        """The customers and products that orders may refer to."""
        return self.silver("customers"), self.silver("products")

    def silver(self, name: str) -> DataFrame:
        return quality.accepted(self.screened(name))

    @cached_property
    def dq_report(self) -> DataFrame:
        return quality.dq_report(self.sources, {name: self.screened(name) for name in self.sources})

    # --- gold -----------------------------------------------------------------------

    @cached_property
    def dim_customer(self) -> DataFrame:
        return model.dim_customer(self.silver("customers"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return model.dim_product(self.silver("products"))

    @cached_property
    def dim_warehouse(self) -> DataFrame:
        return model.dim_warehouse(self.silver("inventory"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return model.dim_date_spanning(self.silver("orders"), "timestamp")

    @cached_property
    def fact_orders(self) -> DataFrame:
        return model.fact_orders(self.silver("orders"), self.silver("products"))

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return model.fact_inventory(self.silver("inventory"))

    @cached_property
    def fact_delivery(self) -> DataFrame:
        kept = quality.kept_orders(self.sources["orders"])
        return model.delivery_facts(quality.order_warehouses(self.silver("delivery"), kept, *self.parents()))

    @cached_property
    def fact_marketing(self) -> DataFrame:
        return model.fact_marketing(self.silver("marketing"))

    def gold(self) -> dict[str, DataFrame]:
        names = (
            "dim_customer",
            "dim_product",
            "dim_warehouse",
            "dim_date",
            "fact_orders",
            "fact_inventory",
            "fact_delivery",
            "fact_marketing",
        )
        return {name: getattr(self, name) for name in names}

    # --- staging variant ------------------------------------------------------------

    def staged(self, name: str, strict: bool = False) -> DataFrame:
        return getattr(staging, f"stg_{name}")(self.sources[name], strict=strict)

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return model.orders_enriched(self.staged("orders"), self.staged("products"), self.staged("customers"))

    # --- derived --------------------------------------------------------------------

    @cached_property
    def kpi_snapshot(self) -> DataFrame:
        return kpis.kpi_snapshot(
            self.fact_orders, self.dim_customer, self.fact_inventory, self.fact_delivery, self.fact_marketing
        )

    @cached_property
    def daily_panel(self) -> DataFrame:
        return timeseries.daily_panel(self.fact_orders, self.fact_delivery)

    @cached_property
    def daily_revenue(self) -> DataFrame:
        return timeseries.daily_revenue(self.fact_orders)

    @cached_property
    def revenue_forecast(self) -> DataFrame:
        return forecast.revenue_forecast(self.daily_revenue)

    def earlier_forecast(self, days: int = 2) -> DataFrame:
        """The forecast as it was made `days` days before the last day of the data."""
        last = self.daily_revenue.agg(F.date_sub(F.max("day"), days)).scalar()
        return forecast.revenue_forecast(self.daily_revenue.filter(F.col("day") <= last))

    @cached_property
    def stockout_alerts(self) -> DataFrame:
        return rules.stockout_alerts(self.fact_inventory, self.fact_orders)


class ParentsOnce(Warehouse):
    """Frames over customers and products that are screened and stored when they are first
    asked for; orders meet their ids and costs as broadcasts while these are few.

    For queries that use the orders in several places with other columns in each, where every
    check and cost would shuffle them by customer and by product.
    """

    def screened(self, name: str) -> DataFrame:
        if name not in self._screened and name in ("customers", "products"):
            self._screened[name] = stored(super().screened(name), f"screened-{name}")
        return super().screened(name)

    @cached_property
    def _parents(self) -> tuple[DataFrame, DataFrame]:
        keys = {"customers": "customer_id", "products": "product_id"}
        return tuple(small_side(self.silver(n).select(k), BROADCAST_PARENTS, f"known-{n}") for n, k in keys.items())

    def parents(self) -> tuple[DataFrame, DataFrame]:
        return self._parents

    @cached_property
    def fact_orders(self) -> DataFrame:
        costs = small_side(self.silver("products").select("product_id", "cost"), BROADCAST_PRODUCTS, "costs")
        # a reader that needs no cost is planned without the join
        return model.fact_orders(self.silver("orders"), one_per_key(costs, "product_id"))


class ScreenedOnce(ParentsOnce):
    """Frames over rows that are screened and stored when they are first asked for.

    For queries that use a layer in several places, in jobs of their own or with other
    columns in each: sources are read and shuffled once, whatever is built on them.
    """

    def screened(self, name: str) -> DataFrame:
        if name not in self._screened:
            if name == "orders":
                kept = stored(quality.kept_orders(self.sources[name]), "kept-orders")
                self._screened[name] = quality.check_stored_orders(kept, *self.parents())
            elif name == "inventory":
                self._screened[name] = stored(super().screened(name), f"screened-{name}")
        return super().screened(name)

    def parents(self) -> tuple[DataFrame, DataFrame]:
        return self.silver("customers"), self.silver("products")

    @cached_property
    def fact_delivery(self) -> DataFrame:
        return model.fact_delivery(self.silver("delivery"), self.silver("orders"))
