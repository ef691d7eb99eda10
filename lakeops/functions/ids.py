"""Ids and id-derived attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The region letter inside warehouse and vehicle ids such as WH-N1 and V-S2.
REGION_LETTERS = {"N": "north", "S": "south", "E": "east", "W": "west"}


def derived_id(*parts: Column) -> Column:
    """Id that depends only on its inputs, so that a repeated run writes the same id (unlike ``uuid()``)."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def region_of(asset_id: Column) -> Column:
    """Region of a warehouse or vehicle id; NULL when the id carries none."""
    letter = F.regexp_extract(asset_id, r"^[A-Z]+-([NSEW])[0-9]+$", 1)
    return F.coalesce(*[F.when(letter == code, F.lit(name)) for code, name in REGION_LETTERS.items()])
