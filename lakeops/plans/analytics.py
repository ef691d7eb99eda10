"""Declared analytics: SLA violations, order anomalies, feature frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lakeops.functions.calendar import calendar_parts
from lakeops.functions.ids import region_of
from lakeops.operators.asof import as_of, last_of_day
from lakeops.operators.joins import with_dimension


def sla_violations(delivery_sla: DataFrame, current_vehicles: DataFrame) -> DataFrame:
    """Deliveries, violations and mean delay per vehicle type and region.

    Deliveries are counted per vehicle before the join.  A vehicle without a known type counts under its id; the region comes
    from the vehicle id.
    """
    late = F.greatest(F.col("actual_minutes") - F.col("sla_minutes"), F.lit(0))
    per_vehicle = delivery_sla.groupBy("vehicle_id").agg(
        F.count("*").alias("deliveries"),
        F.count_if(F.col("actual_minutes") > F.col("sla_minutes")).alias("violations"),
        F.sum(late).alias("late_minutes"),
    )
    typed = per_vehicle.join(current_vehicles.select("vehicle_id", "type"), "vehicle_id", "left")
    grouped = typed.groupBy(
        F.coalesce("type", "vehicle_id").alias("vehicle_type"),
        F.coalesce(region_of(F.col("vehicle_id")), F.lit("unknown")).alias("region"),
    ).agg(
        F.sum("deliveries").alias("deliveries"),
        F.sum("violations").alias("violations"),
        F.sum("late_minutes").alias("late_minutes"),
    )
    return grouped.withColumn("violation_rate", F.col("violations").cast("double") / F.col("deliveries").cast("double"))


def order_anomalies(fact_orders: DataFrame, deviations: float = 3.0) -> DataFrame:
    """Days on which a product's ordered quantity is more than ``deviations`` sample standard deviations off its daily mean.

    Orders collapse to daily totals first, so the per-product window holds one row per day.  Mean and variance come from exact
    decimal sums (``n * sum of squares - square of the sum``, no cancellation), so totals of billions keep all digits and the
    result does not depend on the order in which rows arrive.
    """
    return _off_the_mean(fact_orders, Window.partitionBy("product_id"), 2, deviations)


def trailing_anomalies(fact_orders: DataFrame, days: int = 28, least: int = 7, deviations: float = 3.0) -> DataFrame:
    """The same, but each day is judged by the ``days`` calendar days before it alone, of which ``least`` must have orders: what was known when it came."""
    date = F.unix_date("event_date")
    return _off_the_mean(fact_orders.where(F.col("event_date").isNotNull()), Window.partitionBy("product_id").orderBy(date).rangeBetween(-days, -1), max(2, least), deviations)


def _off_the_mean(fact_orders: DataFrame, judged_by: WindowSpec, least: int, deviations: float) -> DataFrame:
    daily = fact_orders.groupBy("product_id", "event_date").agg(F.sum("qty").alias("qty"))
    exact = F.col("qty").cast("decimal(19,0)")
    whole = lambda c: c.cast("decimal(38,0)")
    summed = daily.select(
        "*",
        F.count("*").over(judged_by).alias("n"),
        whole(F.sum(exact).over(judged_by)).alias("s"),
        whole(F.sum(whole(exact * exact)).over(judged_by)).alias("ss"),
    ).where(F.col("n") >= least)
    mean = F.col("s").cast("double") / F.col("n").cast("double")
    spread = whole(F.col("n").cast("decimal(19,0)") * F.col("ss")) - whole(F.col("s") * F.col("s"))
    variance = spread.cast("double") / (F.col("n") * (F.col("n") - 1)).cast("double")
    measured = summed.select("product_id", "event_date", "qty", mean.alias("mean_qty"), F.sqrt(variance).alias("sd_qty"))
    off = F.col("qty").cast("double") - F.col("mean_qty")
    return measured.where((F.col("sd_qty") > 0) & (F.abs(off) > F.lit(float(deviations)) * F.col("sd_qty")))


def order_features(fact_orders: DataFrame, current_products: DataFrame, current_warehouses: DataFrame) -> DataFrame:
    """Training rows: each order with calendar parts and the attributes of its product and warehouse."""
    products = current_products.select("product_id", "category", "unit_cost", F.col("first_seen").alias("product_first_seen"))
    warehouses = current_warehouses.select("warehouse_id", F.col("region").alias("listed_region"), "capacity")
    joined = with_dimension(fact_orders, products, "product_id", spread_by="event_id")
    joined = with_dimension(joined, warehouses, "warehouse_id", spread_by="event_id")
    return joined.select(
        "event_id",
        "order_id",
        "product_id",
        "warehouse_id",
        "qty",
        "event_date",
        *calendar_parts(F.col("event_date")),
        "category",
        "unit_cost",
        F.datediff("event_date", "product_first_seen").alias("product_age_days"),
        F.coalesce("listed_region", region_of(F.col("warehouse_id"))).alias("region"),
        "capacity",
    )


def features_as_known(fact_orders: DataFrame, stockout_risks: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Training rows without a look ahead: each order with the newest risk and forecast of its product that were there before its day."""
    risks = last_of_day(stockout_risks, "product_id", "event_date", ["risk_score", "confidence"], ["event_ts", "event_id"])
    demand = last_of_day(forecasts, "product_id", "event_date", ["forecast_qty"], ["event_ts", "event_id"])
    orders = fact_orders.select("event_id", "order_id", "product_id", "warehouse_id", "qty", "event_date")
    known = as_of(orders, risks, "product_id", "event_date", ["risk_score", "confidence"]).withColumnRenamed("known_since", "risk_since")
    return as_of(known, demand, "product_id", "event_date", ["forecast_qty"]).withColumnRenamed("known_since", "forecast_since")
