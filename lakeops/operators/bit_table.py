"""Bit tables: which of many keys may be in a set, in a broadcast of bounded size.

A table has ``SLOTS`` words of 64 bits; a key's 64-bit hash names one bit of it.  It is built by a hash aggregate (``bit_or`` per word) and kept as a frame of its
words that are not zero, so it never has more than ``SLOTS`` rows of 16 bytes, however many keys went in.  A bit that is not set proves that the key is
not in the set; a set bit proves nothing (of n keys, about n / 67 million of the others find theirs set), so whatever it lets through is checked exactly afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20


def key_hash(*keys: str | Column) -> Column:
    return F.xxhash64(*keys)


def _slot(hashed: Column, slots: int) -> Column:
    return F.pmod(hashed, F.lit(slots))


def _bit(hashed: Column) -> Column:
    """A long with one bit set, chosen by the hash's upper part."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 58).cast("int"))


def bit_table(hashes: DataFrame, slots: int = SLOTS, **members: Column | None) -> DataFrame:
    """The words of one table per member, of the rows where its condition holds (None: of all rows).  ``hashes`` has the column ``__h``."""
    bit = _bit(F.col("__h"))
    words = [F.bit_or(bit if c is None else F.when(c, bit).otherwise(F.lit(0).cast("long"))).alias(f"__{name}") for name, c in members.items()]
    table = hashes.groupBy(_slot(F.col("__h"), slots).alias("__slot")).agg(*words)
    return table.where(reduce(Column.bitwiseOR, [F.col(f"__{name}") for name in members]) != 0)


def with_marks(df: DataFrame, hashed: Column, table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``df`` with a Boolean column per member of the table: false if the key is certainly not in its set."""
    names = [c for c in table.columns if c != "__slot"]
    met = df.withColumn("__at", _slot(hashed, slots)).join(F.broadcast(table), F.col("__at") == F.col("__slot"), "left")
    set_bits = {name: F.coalesce(F.col(name).bitwiseAND(_bit(hashed)) != 0, F.lit(False)) for name in names}
    return met.withColumns(set_bits).drop("__at", "__slot")
