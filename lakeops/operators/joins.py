"""Fact joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024


HOT_SHARE = 0.002  # of a fact's rows: keys with that many are spread, so 500 at most


def _bytes_of(field: T.StructField) -> Column:
    """A bound of what one value takes in memory."""
    name = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 16
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)) + 16
    return F.lit(16 if isinstance(field.dataType, T.DecimalType) else 8)


def fits_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows stay under the limit in memory: text by its length, other values by their width. One small aggregate row reaches the driver."""
    row = reduce(Column.__add__, [_bytes_of(f) for f in df.schema.fields], F.lit(16)).cast("bigint")
    return (df.select(F.sum(row).alias("bytes")).first()[0] or 0) <= limit_bytes


def frequent_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold ``share`` of the rows or more, without NULL: at most 1 / share of them.

    A frequent-items sketch names the candidates: every task keeps 1 / share counters and the counters are merged, so its size does not depend on the number of
    keys, and no key that reaches the share is missed.  A second pass over the key column counts the candidates.
    """
    known = df.where(F.col(key).isNotNull()).select(key)
    found = known.freqItems([key], share).first()[0]
    if not found:
        return []
    counts = df.groupBy(F.when(F.col(key).isin(found), F.col(key)).alias("k")).agg(F.count("*").alias("n")).collect()  # 1 / share rows at most
    least = share * sum(r["n"] for r in counts)
    return sorted(r["k"] for r in counts if r["k"] is not None and r["n"] >= least)


def with_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: str,
    salts: int = 64,
    limit_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Left join of a fact to a one-row-per-key dimension; every fact row comes out once.

    The dimension is read twice, to measure and to join: pass a stored table, or a derived one through ``computed_once``.
    A dimension measured to be small is broadcast and the fact is not shuffled.  A larger one is joined on (key, salt): the fact's frequent keys, found by a
    sketch over its key column, spread over ``salts`` reducers and so do its NULL keys, which meet nothing; of the dimension only the rows of frequent
    keys are repeated, once per salt.  All other keys have the one salt 0.
    """
    if fits_broadcast(dimension, limit_bytes):
        return fact.join(F.broadcast(dimension), key, "left")
    hot = frequent_keys(fact, key, hot_share)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    salted_fact = fact.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), salt).otherwise(F.lit(0)))
    repeats = F.when(is_hot, F.lit(salts)).otherwise(F.lit(1))
    salted_dimension = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), repeats - 1)))
    return salted_fact.join(salted_dimension, [key, "_salt"], "left").drop("_salt")


def returns_per_order(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """Returns joined to orders on ``order_id``, as counts: one row per (order_id, warehouse_id).

    ``total_returns`` is the number of joined pairs, a bigint; a product beyond it fails the job in ANSI mode instead of wrapping.  ``event_date`` is the earliest return.  Counting each side first keeps the
    fan-out (returns x orders of an id) as a product instead of emitting the pairs, and both counts combine on the map side.
    """
    counted_returns = (
        returns.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count("*").alias("n_returns"), F.min("event_date").alias("event_date"))
    )
    counted_orders = (
        orders.where(F.col("order_id").isNotNull()).groupBy("order_id", "warehouse_id").agg(F.count("*").alias("n_orders"))
    )
    return counted_returns.join(counted_orders, "order_id").select(
        "order_id", "warehouse_id", (F.col("n_returns") * F.col("n_orders")).alias("total_returns"), "event_date"
    )
