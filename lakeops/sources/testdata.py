"""The driver's test tables seen as raw event tables.

Each raw table is a projection of one test table, written with functions that Spark SQL and other SQL engines spell the same,
so that a checking engine can run the same text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_LETTER = "substr('NSEW', cast({key} % 4 as int) + 1, 1)"


@dataclass(frozen=True)
class Derived:
    source: str
    columns: dict[str, str]
    where: str | None = None

    def sql(self) -> str:
        listed = ", ".join(f"{expr} AS {name}" for name, expr in self.columns.items())
        return f"SELECT {listed} FROM {self.source}" + (f" WHERE {self.where}" if self.where else "")


def _product(key: str) -> str:
    return f"concat('P', lpad(cast({key} % 99 + 1 as string), 5, '0'))"


def _place(prefix: str, key: str) -> str:
    return f"concat('{prefix}-', {_LETTER.format(key=key)}, cast({key} % 3 + 1 as string))"


def _line(prefix: str) -> str:
    return f"concat('{prefix}-', cast(l_orderkey as string), '-', cast(l_linenumber as string))"


def _choice(key: str, values: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {cases} END"


def _prefixed(prefix: str, key: str) -> str:
    return f"concat('{prefix}-', cast({key} as string))"


# Fixed values below: event types, reason, status, error and region codes of the feeds.
RAW: dict[str, Derived] = {
    "raw_orders": Derived(
        "orders",
        {
            "event_id": _prefixed("o", "o_orderkey"),
            "event_ts": "o_orderdate",
            "event_type": "'order_created'",
            "order_id": "cast(o_orderkey as string)",
            "product_id": _product("o_orderkey"),
            "warehouse_id": _place("WH", "o_custkey"),
            "order_ts": "o_orderdate",
            "qty": "o_custkey % 20 + 1",
            "event_date": "cast(o_orderdate as date)",
        },
    ),
    "raw_returns": Derived(
        "lineitem",
        {
            "event_id": _line("r"),
            "event_ts": "l_shipdate",
            "event_type": "'return_created'",
            "return_id": _line("r"),
            "order_id": "cast(l_orderkey as string)",
            "return_ts": "l_shipdate",
            "reason_code": _choice("l_linenumber", ("DAMAGED", "WRONG_ITEM", "NOT_NEEDED", "OTHER")),
            "event_date": "cast(l_shipdate as date)",
        },
        "l_returnflag = 'R'",
    ),
    "raw_inventory_movements": Derived(
        "lineitem",
        {
            "event_id": _line("i"),
            "event_ts": "l_shipdate",
            "event_type": "'inventory_movement'",
            "movement_id": _line("m"),
            "product_id": _product("l_partkey"),
            "delta_qty": "cast(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity END as bigint)",
            "source_type": "CASE l_returnflag WHEN 'R' THEN 'RESTOCK' WHEN 'N' THEN 'SALE' ELSE 'ADJUSTMENT' END",
            "event_date": "cast(l_shipdate as date)",
        },
    ),
    "raw_dispatch_logs": Derived(
        "lineitem",
        {
            "event_id": _line("d"),
            "event_ts": "l_shipdate",
            "event_type": "'dispatch_log'",
            "dispatch_id": _line("d"),
            "order_id": "cast(l_orderkey as string)",
            "vehicle_id": _place("V", "l_suppkey"),
            "status": _choice("l_linenumber", ("ASSIGNED", "EN_ROUTE", "DELIVERED", "FAILED")),
            "eta": "l_shipdate + interval '30' minute",
            "event_date": "cast(l_shipdate as date)",
        },
    ),
    "raw_order_errors": Derived(
        "events",
        {
            "event_id": _prefixed("e", "event_id"),
            "event_ts": "ts",
            "event_type": "'order_error'",
            "error_id": _prefixed("x", "event_id"),
            "order_id": "cast(user_id as string)",
            "error_code": _choice("event_id", ("OUT_OF_STOCK", "PAYMENT_FAILED", "ADDRESS_INVALID", "UNKNOWN")),
            "error_ts": "ts",
            "event_date": "cast(ts as date)",
        },
        "event_type = 'error'",
    ),
    "raw_restocks": Derived(
        "lineitem",
        {
            "event_id": _line("s"),
            "event_ts": "l_shipdate",
            "event_type": "'restock_received'",
            "restock_id": _line("s"),
            "product_id": _product("l_partkey"),
            "warehouse_id": _place("WH", "l_suppkey"),
            "restock_ts": "l_shipdate",
            "qty": "l_partkey % 91 + 10",
            "event_date": "cast(l_shipdate as date)",
        },
    ),
    "raw_vehicle_tracking": Derived(
        "events",
        {
            "event_id": _prefixed("t", "event_id"),
            "event_ts": "ts",
            "event_type": "'vehicle_tracking'",
            "vehicle_id": "concat('VEH-', lpad(cast(user_id % 49 + 1 as string), 3, '0'))",
            "latitude": "cast(event_id % 18000 as double) / 100 - 90",
            "longitude": "cast(event_id % 36000 as double) / 100 - 180",
            "speed_kph": "event_id % 121",
            "event_date": "cast(ts as date)",
        },
    ),
    "raw_route_updates": Derived(
        "events",
        {
            "event_id": _prefixed("u", "event_id"),
            "event_ts": "ts",
            "event_type": "'route_update'",
            "route_id": "concat('ROUTE-', lpad(cast(user_id % 60 + 1 as string), 4, '0'))",
            "status": _choice("event_id", ("ASSIGNED", "IN_TRANSIT", "DELIVERED", "DELAYED")),
            "updated_ts": "ts",
            "event_date": "cast(ts as date)",
        },
    ),
    "raw_delivery_sla": Derived(
        "lineitem",
        {
            "event_id": _line("l"),
            "event_ts": "l_shipdate",
            "event_type": "'delivery_sla'",
            "order_id": "cast(l_orderkey as string)",
            "vehicle_id": _place("V", "l_suppkey"),
            "sla_minutes": "l_orderkey % 211 + 30",
            "actual_minutes": "greatest(0, l_orderkey % 211 + l_partkey % 91)",
            "event_date": "cast(l_shipdate as date)",
        },
    ),
    "raw_demand_forecast": Derived(
        "orders",
        {
            "event_id": _prefixed("f", "o_orderkey"),
            "event_ts": "o_orderdate",
            "event_type": "'demand_forecast'",
            "product_id": _product("o_orderkey"),
            "region": _choice("o_custkey", ("north", "south", "east", "west")),
            "forecast_ts": "o_orderdate",
            "forecast_qty": "o_custkey % 451 + 50",
            "event_date": "cast(o_orderdate as date)",
        },
    ),
    "raw_sla_risk": Derived(
        "orders",
        {
            "event_id": _prefixed("k", "o_orderkey"),
            "event_ts": "o_orderdate",
            "event_type": "'sla_risk'",
            "order_id": "cast(o_orderkey as string)",
            "risk_score": "cast(o_custkey % 101 as double) / 100",
            "predicted_delay_minutes": "o_orderkey % 181",
            "confidence": "cast(o_orderkey % 31 + 70 as double) / 100",
            "event_date": "cast(o_orderdate as date)",
        },
    ),
    "raw_stockout_risk": Derived(
        "orders",
        {
            "event_id": _prefixed("z", "o_orderkey"),
            "event_ts": "o_orderdate",
            "event_type": "'stockout_risk'",
            "product_id": _product("o_orderkey"),
            "risk_score": "cast(o_custkey % 129 as double) / 128",
            "predicted_date": "cast(o_orderdate + interval '12' day as date)",
            "confidence": "cast(o_orderkey % 31 + 70 as double) / 100",
            "event_date": "cast(o_orderdate as date)",
        },
    ),
}


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project(df: DataFrame, name: str) -> DataFrame:
    """The raw table ``name`` of its (batch or streaming) source table."""
    derived = RAW[name]
    rows = df.where(derived.where) if derived.where else df
    return rows.selectExpr(*[f"{expr} AS {column}" for column, expr in derived.columns.items()])


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return project(source_table(spark, sf_dir, RAW[name].source), name)


def spread(df: DataFrame) -> DataFrame:
    """A scan's rows over at least one task per core, for heavy per-row work on a source of few row groups.

    A source of many files has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
