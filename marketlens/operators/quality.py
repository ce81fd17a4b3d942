"""Silver layer: screening of the sources and the data-quality report.

Every source goes through `screen` once: complete rows are reduced to one per key and
marked with the reason for which they are refused, if any. Accepted rows, refused rows
and the counters of each rule are read from that one result; the report adds row
counts of the raw source, which need no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.columns import as_timestamp
from marketlens.operators.dedup import keep_one
from marketlens.operators.lookup import lookup, one_per_key, small_side
from marketlens.sources.files import ARRIVAL
from marketlens.sources.schemas import SOURCE_SCHEMAS, field_types

# Sources in the order in which they can be screened: orders refer to accepted
# customers and products.
SOURCES = ["customers", "products", "orders", "inventory", "delivery", "support", "marketing"]

REASON = "reject_reason"

# Columns without which a row is dropped before deduplication.
REQUIRED = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id", "customer_id", "product_id", "amount"],
    "inventory": ["product_id", "warehouse_id"],
    "delivery": ["order_id"],
    "support": ["ticket_id"],
    "marketing": ["campaign_id", "date"],
}

# Rule names of the data-quality report.
NEGATIVE_AMOUNT = "negative_amount"
INVALID_TIMESTAMP = "invalid_timestamp"
REFERENTIAL = "referential_integrity_customer_or_product"
DUPLICATE_ORDER = "duplicate_order_id"
NON_POSITIVE_PRICE = "non_positive_selling_price"
NULL_OR_DUP_PRODUCT = "null_or_dup_product_id"
NULL_OR_DUP_CUSTOMER = "null_or_dup_customer_id"
NEGATIVE_QUANTITY = "negative_quantity"
DROPPED_TOTAL = "rows_dropped_total"

MISSING_PRICE = "missing_price"

_TIME = "_time"

# ids without a parent, 8 bytes or a short text each; beyond this the orders are shuffled by id
BROADCAST_IDS = 1_000_000


def _complete(source: str) -> str:
    """Plain null checks: they reach the scan, and joins infer nothing beyond them."""
    return " and ".join(f"`{c}` is not null" for c in REQUIRED[source])


def _numbers(source: str, raw: DataFrame) -> dict[str, str]:
    """Number columns of a source that are stored as text, with their types."""
    declared = field_types(SOURCE_SCHEMAS[source])
    return {c: t for c, t in declared.items() if t in ("int", "double") and dict(raw.dtypes).get(c) == "string"}


def readable(source: str, raw: DataFrame) -> DataFrame:
    """`raw` with the declared numbers; text that is none becomes null."""
    return raw.withColumns({c: F.col(c).try_cast(t) for c, t in _numbers(source, raw).items()})


def unreadable(source: str, raw: DataFrame) -> DataFrame:
    """Rows `(table_name, column_name, unreadable)`: values that are there but no number."""
    counts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias("unreadable"),
        )
        for c, t in _numbers(source, raw).items()
    ]
    found = F.array(*counts) if counts else F.array().cast("array<struct<column_name:string,unreadable:bigint>>")
    return raw.agg(found.alias("found")).select(F.lit(f"bronze_{source}").alias("table_name"), F.inline("found"))


def screen(source: str, raw: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """Complete rows, one per key, with an empty reject reason.

    With an arrival column the first or last copy in file order is kept; without one
    (tables have no file order) the copy with the largest `order` columns. Numbers that come
    as text are read here; what is no number becomes null (see `unreadable`).
    """
    complete = readable(source, raw).filter(_complete(source))
    if ARRIVAL in raw.columns:
        kept = keep_one(complete, keys, [ARRIVAL], largest=keep == "last", unique=True).drop(ARRIVAL)
    else:
        kept = keep_one(complete, keys, order)
    return kept.withColumn(REASON, F.lit(None).cast("string"))


def refuse(screened: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Charges each row to the first rule (reason -> condition) it meets, unless already
    refused. A condition that is unknown does not refuse."""
    cases = " ".join(f"when {condition} then '{reason}'" for reason, condition in rules.items())
    return screened.withColumn(REASON, F.expr(f"case when {REASON} is not null then {REASON} {cases} end"))


def accepted(screened: DataFrame) -> DataFrame:
    return screened.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(screened: DataFrame) -> DataFrame:
    """Refused rows with their reason."""
    return screened.filter(F.col(REASON).isNotNull())


# --- one screening per source -------------------------------------------------------


def screen_customers(raw: DataFrame) -> DataFrame:
    return screen("customers", raw, ["customer_id"], ["registration_date"])


def screen_products(raw: DataFrame) -> DataFrame:
    kept = screen("products", raw, ["product_id"], ["selling_price"])
    return refuse(kept, {NON_POSITIVE_PRICE: "selling_price <= 0", MISSING_PRICE: "selling_price is null"})


def kept_orders(raw: DataFrame) -> DataFrame:
    """One row per order, not checked yet. Copies are ranked by the time they state; one that
    states none comes last."""
    timed = raw.withColumn(_TIME, as_timestamp("timestamp"))
    return screen("orders", timed, ["order_id"], [_TIME, "timestamp"]).drop(_TIME)


def screen_orders(raw: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """`customers` and `products` are the accepted (silver) ones: an order of a product
    refused for its price is an orphan too. The checks run after deduplication and a
    row is charged to the first one it fails."""
    return check_orders(kept_orders(raw), customers, products)


def order_warehouses(delivery: DataFrame, kept: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """`delivery` with the warehouse of its order, null for one that is refused or unknown.

    Deliveries and orders are joined as they come out of their deduplication, partitioned by
    order; the checks follow on the joined rows, so orders are not shuffled by order again.
    Figures that do not ask for the warehouse are planned without orders and checks.
    """
    order = kept.select("order_id", "customer_id", "product_id", "amount", "timestamp", "warehouse_id", REASON)
    known = one_per_key(customers.select("customer_id"), "customer_id"), one_per_key(products.select("product_id"), "product_id")
    checked = check_orders(delivery.join(one_per_key(order, "order_id"), "order_id", "left"), *known)
    warehouse = F.when(F.col(REASON).isNull(), F.col("warehouse_id")).alias("warehouse_id")
    return checked.select(*delivery.columns, warehouse)


def check_orders(kept: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Charges rows that have the columns of an order to the first check they fail."""
    known_customer = customers.selectExpr("customer_id", "true as _customer")
    known_product = products.selectExpr("product_id", "true as _product")
    flagged = lookup(lookup(kept, known_customer, "customer_id"), known_product, "product_id")
    return _charged(flagged, "_customer is null or _product is null").select(*kept.columns)


def check_stored_orders(kept: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """As `check_orders`, for orders that are stored and have no null ids. Only ids are shuffled: those
    of the orders are made distinct and reduced to the ones without a parent, which are few unless
    a parent is missing as a whole; the orders meet these where they are read. Runs jobs."""
    flagged = kept
    for key, parent in (("customer_id", customers), ("product_id", products)):
        unknown = kept.select(key).distinct().join(parent.select(key), key, "left_anti")
        unknown = small_side(unknown, BROADCAST_IDS, f"unknown-{key}").withColumn(f"_no_{key}", F.lit(True))
        flagged = lookup(flagged, unknown, key)
    return _charged(flagged, "_no_customer_id or _no_product_id").select(*kept.columns)


def _charged(flagged: DataFrame, orphan: str) -> DataFrame:
    """Orders with their time read, charged to the first check they fail."""
    timed = flagged.withColumn("timestamp", as_timestamp("timestamp"))
    return refuse(
        timed,
        {
            REFERENTIAL: orphan,
            NEGATIVE_AMOUNT: "amount < 0",
            INVALID_TIMESTAMP: "timestamp is null",
        },
    )


def screen_inventory(raw: DataFrame) -> DataFrame:
    """Null quantities are kept; only a quantity known to be negative is refused."""
    kept = screen("inventory", raw, ["product_id", "warehouse_id"], ["updated_at"], keep="last")
    return refuse(kept, {NEGATIVE_QUANTITY: "available_qty < 0 or reserved_qty < 0"})


def screen_delivery(raw: DataFrame) -> DataFrame:
    kept = screen("delivery", raw, ["order_id"], ["actual_delivery"], keep="last")
    times = ("pickup_time", "expected_delivery", "actual_delivery")
    return kept.withColumns({c: as_timestamp(c) for c in times})


def screen_support(raw: DataFrame) -> DataFrame:
    return screen("support", raw, ["ticket_id"], ["created_at"])


def screen_marketing(raw: DataFrame) -> DataFrame:
    return screen("marketing", raw, ["date", "channel", "campaign_id"], ["spend"])


# --- counters -----------------------------------------------------------------------

# Rules a source charges single rows to.
CHARGED = {
    "products": [NON_POSITIVE_PRICE],
    "orders": [REFERENTIAL, NEGATIVE_AMOUNT, INVALID_TIMESTAMP],
    "inventory": [NEGATIVE_QUANTITY],
}


def _report_entries(source: str) -> dict[str, str]:
    """Rule names of a source with the expression of their counter."""
    charged = {rule: f"`{rule}`" for rule in CHARGED.get(source, [])}
    dropped = "total - accepted"
    if source == "customers":
        return {NULL_OR_DUP_CUSTOMER: dropped}
    if source == "products":
        return {**charged, NULL_OR_DUP_PRODUCT: f"{dropped} - {charged[NON_POSITIVE_PRICE]}"}
    if source == "orders":
        return {DUPLICATE_ORDER: "complete - kept", **charged, DROPPED_TOTAL: dropped}
    return {**charged, DROPPED_TOTAL: dropped}


def counters(source: str, raw: DataFrame, screened: DataFrame) -> DataFrame:
    """Rows `(table_name, rule, failed_rows)` of one source.

    Counts of the raw and of the screened rows are stacked and added up, so neither
    waits for the other and nothing is joined."""
    typed = readable(source, raw)
    before = typed.agg(F.count(F.lit(1)).alias("total"), F.expr(f"count_if({_complete(source)}) as complete"))
    after = screened.agg(
        F.count(F.lit(1)).alias("kept"),
        F.expr(f"count_if({REASON} is null) as accepted"),
        *[F.expr(f"count_if({REASON} = '{rule}') as `{rule}`") for rule in CHARGED.get(source, [])],
    )
    stacked = before.unionByName(after, allowMissingColumns=True)
    counts = stacked.agg(*[F.sum(c).alias(c) for c in stacked.columns])
    entries = ", ".join(
        f"struct('{rule}' as rule, {count} as failed_rows)" for rule, count in _report_entries(source).items()
    )
    return counts.selectExpr(f"'silver_{source}' as table_name", f"inline(array({entries}))")


class Watch:
    """The counters of one source, taken while its screened rows are written."""

    def __init__(self, source: str):
        self.source = source
        self.read, self.kept = Observation(f"{source} as read"), Observation(f"{source} screened")

    def before(self, raw: DataFrame) -> DataFrame:
        """The rows that go into the screening."""
        total = F.count(F.lit(1)).alias("total")
        return raw.observe(self.read, total, F.expr(f"count_if({_complete(self.source)})").alias("complete"))

    def after(self, screened: DataFrame) -> DataFrame:
        """The rows that come out of it, to be written once."""
        charged = [F.count_if(F.col(REASON) == rule).alias(rule) for rule in CHARGED.get(self.source, [])]
        accepted_rows = F.count_if(F.col(REASON).isNull()).alias("accepted")
        return screened.observe(self.kept, F.count(F.lit(1)).alias("kept"), accepted_rows, *charged)

    def report(self, spark: SparkSession) -> DataFrame:
        """Rows `(table_name, rule, failed_rows)`; waits for the write."""
        counts = {k: int(v or 0) for seen in (self.read, self.kept) for k, v in seen.get.items()}
        one = spark.createDataFrame([tuple(counts.values())], ", ".join(f"`{c}` bigint" for c in counts))
        entries = ", ".join(f"struct('{r}' as rule, {c} as failed_rows)" for r, c in _report_entries(self.source).items())
        return one.selectExpr(f"'silver_{self.source}' as table_name", f"inline(array({entries}))")


def store_screened(
    sources: Mapping[str, DataFrame], store: Callable[[str, DataFrame], DataFrame]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Screens and stores every source; gives the screened rows and the quality report.

    `store` writes a frame once and gives what a reader of it sees. All counters of a source
    come out of that write: the source is scanned once, and accepted customers and products,
    to which orders refer, are read from where they were stored.
    """
    kept: dict[str, DataFrame] = {}
    reports = []
    for name in [s for s in SOURCES if s in sources]:
        watch = Watch(name)
        raw = watch.before(readable(name, sources[name]))
        parents = [accepted(kept["customers"]), accepted(kept["products"])] if name == "orders" else []
        kept[name] = store(name, watch.after(globals()[f"screen_{name}"](raw, *parents)))
        reports.append(watch.report(raw.sparkSession))
    return kept, reduce(DataFrame.unionByName, reports).withColumn("checked_at", F.current_timestamp())


def dq_report(raw: Mapping[str, DataFrame], screened: Mapping[str, DataFrame]) -> DataFrame:
    """The quality report over all screened sources, stamped with the time of the run."""
    parts = [counters(source, raw[source], frame) for source, frame in screened.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("checked_at", F.current_timestamp())
