"""Explicit schemas: the seven source files, the event payloads and the output tables.

All are DDL strings, which readers, `from_json` and `createDataFrame` take as they are.
Columns that may hold malformed text (times, dates) are read as strings; the
silver and staging steps decide how strictly they are parsed.
"""

from __future__ import annotations


# Source names and column names of the seven input files.
SOURCE_SCHEMAS: dict[str, str] = {
    "orders": (
        "order_id string, customer_id string, product_id string, warehouse_id string, "
        "timestamp string, quantity int, amount double, status string"
    ),
    "customers": (
        "customer_id string, city string, state string, segment string, registration_date string"
    ),
    "products": (
        "product_id string, category string, brand string, cost double, selling_price double, supplier_id string"
    ),
    "inventory": (
        "warehouse_id string, product_id string, available_qty int, reserved_qty int, "
        "reorder_level int, updated_at string"
    ),
    "delivery": (
        "order_id string, partner string, pickup_time string, expected_delivery string, "
        "actual_delivery string, status string"
    ),
    "support": (
        "ticket_id string, customer_id string, order_id string, issue_type string, priority string, "
        "created_at string, resolved_at string"
    ),
    "marketing": (
        "campaign_id string, date string, channel string, spend double, impressions int, "
        "clicks int, conversions int"
    ),
}

# Topic names, event types and payload fields of the live feed.
TOPICS = {
    "order_created": "orders.events",
    "payment_processed": "payments.events",
    "delivery_update": "delivery.events",
    "inventory_adjustment": "inventory.events",
}
PAYLOAD_FIELDS: dict[str, str] = {
    "order_created": (
        "order_id string, customer_id string, product_id string, warehouse_id string, "
        "quantity int, amount double, status string, timestamp string"
    ),
    "payment_processed": "order_id string, amount double, result string, timestamp string",
    "delivery_update": "order_id string, partner string, status string, sla_breach boolean, timestamp string",
    "inventory_adjustment": "warehouse_id string, product_id string, delta_qty int, timestamp string",
}

ALERTS = (
    "alert_id string, rule string, severity string, status string, entity string, message string, "
    "created_at timestamp, notified boolean"
)


def field_types(ddl: str) -> dict[str, str]:
    """Column names and types of a DDL string of flat columns."""
    return dict(part.strip().split(" ", 1) for part in ddl.split(", "))
