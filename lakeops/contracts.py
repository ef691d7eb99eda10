"""Declarative contracts: which columns each feed and table carries.

A *feed* is a stream of flat JSON events (one queue per region, or one central queue).  A *table* is a dataset stored under
``<warehouse>/<module>/<name>``.  Both are data, not code: ingest, curation, checks and views are all driven by them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The type names a column list may use, and the region names of the regional feeds.
TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DATE": T.DateType(),
}
REGIONS = ("north", "south", "east", "west")


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    json_name: str | None = None  # name in the JSON payload when it differs from the column name
    default: str | None = None  # CSV replay: "uuid", "now" or None (the CSV must carry it)

    @property
    def source(self) -> str:
        return self.json_name or self.name


@dataclass(frozen=True)
class Feed:
    """One kind of event: its payload, the raw table it lands in and the column its ``event_date`` comes from."""

    name: str
    event_type: str
    table: str
    columns: tuple[Column, ...]
    date_field: str
    regional: bool = False

    @property
    def queues(self) -> tuple[str, ...]:
        return tuple(f"{self.name}_{r}" for r in REGIONS) if self.regional else (self.name,)


@dataclass(frozen=True)
class Table:
    """A stored table. ``mark`` is the column whose maximum is the table's high-water mark."""

    name: str
    columns: tuple[Column, ...]
    mark: str | None = None
    key: str | None = None

    @property
    def module(self) -> str:
        return self.name.split(".", 1)[0]

    @property
    def short_name(self) -> str:
        return self.name.split(".", 1)[1]

    @property
    def schema(self) -> T.StructType:
        return schema_of(self.columns)

    @property
    def column_names(self) -> list[str]:
        return self.schema.fieldNames()


def schema_of(columns) -> T.StructType:
    """Nullable Spark schema of a column list; adds ``event_date`` when it is not listed and rejects unknown types."""
    fields = []
    for c in columns:
        kind = c.kind.upper()
        if kind not in TYPES:
            raise ValueError(f"unsupported column type {c.kind!r} for column {c.name!r}")
        fields.append(T.StructField(c.name, TYPES[kind], True))
    if "event_date" not in [f.name for f in fields]:
        fields.append(T.StructField("event_date", T.DateType(), True))
    return T.StructType(fields)


def columns(text: str) -> tuple[Column, ...]:
    """Parse ``"name KIND, name KIND"`` into columns."""
    return tuple(Column(*item.split()) for item in text.split(","))


_ENVELOPE = (
    Column("event_id", "STRING", default="uuid"),
    Column("event_ts", "TIMESTAMP", default="now"),
    Column("event_type", "STRING"),
)


def _feed(name, event_type, table, payload, date_field, regional=False) -> Feed:
    return Feed(name, event_type, table, _ENVELOPE + tuple(payload), date_field, regional)


# The event feeds, their payload fields and event types.
FEEDS: dict[str, Feed] = {
    f.name: f
    for f in (
        _feed(
            "orders",
            "order_created",
            "orders.raw_orders",
            (
                Column("order_id", "STRING", default="uuid"),
                *columns("product_id STRING, warehouse_id STRING, order_ts TIMESTAMP, qty LONG"),
            ),
            "order_ts",
            regional=True,
        ),
        _feed(
            "returns",
            "return_created",
            "returns.raw_returns",
            (
                Column("return_id", "STRING", default="uuid"),
                *columns("order_id STRING, return_ts TIMESTAMP, reason_code STRING"),
            ),
            "return_ts",
            regional=True,
        ),
        _feed(
            "inventory",
            "inventory_movement",
            "inventory.raw_inventory_movements",
            (
                Column("movement_id", "STRING", default="uuid"),
                *columns("product_id STRING, delta_qty LONG, source_type STRING"),
            ),
            "event_ts",
            regional=True,
        ),
        _feed(
            "errors",
            "order_error",
            "order_errors.raw_order_errors",
            (
                Column("error_id", "STRING", default="uuid"),
                *columns("order_id STRING, error_code STRING"),
                Column("error_ts", "TIMESTAMP", json_name="detected_ts"),
            ),
            "error_ts",
            regional=True,
        ),
        _feed(
            "dispatch_logs",
            "dispatch_log",
            "dispatch_logs.raw_dispatch_logs",
            (
                Column("dispatch_id", "STRING", default="uuid"),
                Column("order_id", "STRING", default="uuid"),
                *columns("vehicle_id STRING, status STRING, eta TIMESTAMP"),
            ),
            "event_ts",
            regional=True,
        ),
        _feed(
            "restocks",
            "restock_received",
            "restocks.raw_restocks",
            (
                Column("restock_id", "STRING", default="uuid"),
                *columns("product_id STRING, warehouse_id STRING, restock_ts TIMESTAMP, qty LONG"),
            ),
            "restock_ts",
            regional=True,
        ),
        _feed(
            "vehicle_tracking",
            "vehicle_tracking",
            "logistics_core.raw_vehicle_tracking",
            columns("vehicle_id STRING, latitude DOUBLE, longitude DOUBLE, speed_kph LONG"),
            "event_ts",
        ),
        _feed(
            "route_updates",
            "route_update",
            "logistics_core.raw_route_updates",
            (*columns("route_id STRING, status STRING"), Column("updated_ts", "TIMESTAMP", default="now")),
            "updated_ts",
        ),
        _feed(
            "delivery_sla",
            "delivery_sla",
            "logistics_core.raw_delivery_sla",
            columns("order_id STRING, vehicle_id STRING, sla_minutes LONG, actual_minutes LONG"),
            "event_ts",
        ),
        _feed(
            "demand_forecast",
            "demand_forecast",
            "ml_insights.raw_demand_forecast",
            columns("product_id STRING, region STRING, forecast_ts TIMESTAMP, forecast_qty LONG"),
            "event_ts",
        ),
        _feed(
            "sla_risk",
            "sla_risk",
            "ml_insights.raw_sla_risk",
            columns("order_id STRING, risk_score DOUBLE, predicted_delay_minutes LONG, confidence DOUBLE"),
            "event_ts",
        ),
        _feed(
            "stockout_risk",
            "stockout_risk",
            "ml_insights.raw_stockout_risk",
            columns("product_id STRING, risk_score DOUBLE, predicted_date DATE, confidence DOUBLE"),
            "event_ts",
        ),
    )
}

_E = "event_id STRING, event_ts TIMESTAMP, event_type STRING, "


def _table(name, text, mark, key=None) -> Table:
    return Table(name, columns(text), mark, key)


# The curated tables and their columns.
_CURATED = (
    _table(
        "orders.fact_orders",
        _E + "order_id STRING, product_id STRING, warehouse_id STRING, order_ts TIMESTAMP, qty LONG, event_date DATE",
        "order_ts",
        "event_id",
    ),
    _table(
        "returns.fact_returns",
        _E + "return_id STRING, order_id STRING, return_ts TIMESTAMP, reason_code STRING, event_date DATE",
        "return_ts",
        "event_id",
    ),
    _table(
        "inventory.fact_inventory_movements",
        _E + "product_id STRING, movement_ts TIMESTAMP, delta_qty LONG, movement_type STRING, event_date DATE",
        "movement_ts",
        "event_id",
    ),
    _table(
        "order_errors.fact_order_errors",
        _E + "error_id STRING, order_id STRING, error_code STRING, error_ts TIMESTAMP, details STRING, event_date DATE",
        "error_ts",
        "event_id",
    ),
    _table(
        "dispatch_logs.fact_dispatch_logs",
        _E + "dispatch_id STRING, vehicle_id STRING, status STRING, eta_ts TIMESTAMP, event_date DATE",
        "event_ts",
        "event_id",
    ),
    _table(
        "logistics_core.fact_vehicle_routes",
        _E + "route_id STRING, status STRING, updated_ts TIMESTAMP, event_date DATE",
        "updated_ts",
        "event_id",
    ),
    _table(
        "ml_insights.fact_forecast_demand",
        _E + "product_id STRING, region STRING, forecast_ts TIMESTAMP, forecast_qty LONG, event_date DATE",
        "event_ts",
        "event_id",
    ),
    _table(
        "ml_insights.fact_stockout_risks",
        _E + "product_id STRING, risk_score DOUBLE, predicted_date DATE, confidence DOUBLE, event_date DATE",
        "event_ts",
        "event_id",
    ),
    _table(
        "dimensions.dim_product",
        "product_id STRING, name STRING, category STRING, unit_cost INT, event_date DATE",
        "event_date",
    ),
    _table(
        "dimensions.dim_warehouse",
        "warehouse_id STRING, region STRING, manager STRING, capacity INT, event_date DATE",
        "event_date",
    ),
    _table(
        "dimensions.dim_vehicle",
        "vehicle_id STRING, type STRING, capacity INT, current_location STRING, event_date DATE",
        "event_date",
    ),
    _table(
        "dimensions.dim_error_code",
        "error_code STRING, description STRING, severity_level STRING, event_date DATE",
        "event_date",
    ),
    _table(
        "dimensions.dim_date",
        "date_id DATE, day INT, week INT, month INT, quarter INT, year INT, event_date DATE",
        "event_date",
    ),
    _table(
        "dimensions.dim_route",
        "route_id STRING, region_covered STRING, avg_duration INT, event_date DATE",
        "event_date",
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in _CURATED}
TABLES.update({f.table: Table(f.table, f.columns, f.date_field, "event_id") for f in FEEDS.values()})

FACTS = tuple(t.name for t in _CURATED if t.short_name.startswith("fact_"))
DIMS = tuple(t.name for t in _CURATED if t.short_name.startswith("dim_"))

# The ten tables whose views the table checks look at.
CHECKED_TABLES = (
    "dimensions.dim_product",
    "dimensions.dim_vehicle",
    "dimensions.dim_warehouse",
    "dimensions.dim_error_code",
    "dimensions.dim_date",
    "orders.fact_orders",
    "returns.fact_returns",
    "dispatch_logs.fact_dispatch_logs",
    "inventory.fact_inventory_movements",
    "order_errors.fact_order_errors",
)
