"""One row per key, and rows whose key is not stored yet.

Almost all keys of a load occur once and are not stored.  So only 64-bit hashes of the keys are shuffled at first: they are counted, and bit tables of bounded size
say of each row whether its key may be repeated, or stored.  Rows for which neither can be are given out without a shuffle; the others are looked at exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.bit_table import bit_table, key_hash, with_marks


def _hash_counts(df: DataFrame, key: str) -> DataFrame:
    return df.select(key_hash(key).alias("__h")).groupBy("__h").agg(F.count("*").alias("__n"))


def _smallest(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key: the smallest by the other columns.  Each task keeps one row per key before the shuffle, however many copies a key has."""
    rest = [c for c in columns if c != key]
    order = Window.partitionBy(key).orderBy(*rest) if rest else Window.partitionBy(key).orderBy(key)
    return df.withColumn("__pick", F.row_number().over(order)).where("__pick = 1").drop("__pick")


def one_row_per(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest by all other columns in declared order, so repeated runs keep the same row.

    ``df`` is read three times: its keys' hashes, the rows of keys that occur once, and those that may not.
    """
    table = bit_table(_hash_counts(df, key), repeated=F.col("__n") > 1)
    marked = with_marks(df, key_hash(key), table)
    once = marked.where(~F.col("__repeated")).select(*df.columns)
    return once.unionByName(_smallest(marked.where("__repeated").select(*df.columns), key, df.columns))


def _stored_keys(stored: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """The stored keys, each once, that may be among those of the table's member ``mine``."""
    return with_marks(stored.select(key), key_hash(key), table).where("__mine").select(key).distinct()


def not_stored(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``df``, one per key by contract, whose key does not occur in ``stored``.

    Of the stored keys only those that may occur in ``df`` are shuffled, and of ``df`` only the rows whose key may be stored.
    """
    mine = bit_table(df.select(key_hash(key).alias("__h")), mine=None)
    known = _stored_keys(stored, key, mine)
    marked = with_marks(df, key_hash(key), bit_table(known.select(key_hash(key).alias("__h")), stored=None))
    new = marked.where(~F.col("__stored")).select(*df.columns)
    return new.unionByName(marked.where("__stored").select(*df.columns).join(known, key, "left_anti").select(*df.columns))


def new_once(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """``not_stored(one_row_per(df, key), stored, key)`` with one count of the hashes and one exact pass for both."""
    own = bit_table(_hash_counts(df, key), mine=None, repeated=F.col("__n") > 1)
    known = _stored_keys(stored, key, own.drop("__repeated"))
    marked = with_marks(df, key_hash(key), own.drop("__mine"))
    marked = with_marks(marked, key_hash(key), bit_table(known.select(key_hash(key).alias("__h")), stored=None))
    doubtful: Column = F.col("__repeated") | F.col("__stored")
    new = marked.where(~doubtful).select(*df.columns)
    rest = _smallest(marked.where(doubtful).select(*df.columns), key, df.columns)
    return new.unionByName(rest.join(known, key, "left_anti").select(*df.columns))
