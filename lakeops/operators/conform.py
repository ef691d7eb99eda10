"""Decode JSON event bodies against a feed contract and split valid from invalid rows.

Each body is parsed once, straight into the contract's fields (``from_json`` skips all other fields).  ``explode(array(x))``
keeps it that way: a filter on the result would otherwise be pushed below the projection and repeat the parse in every
predicate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.contracts import Feed
from lakeops.functions import coerce


def _once(value: Column) -> Column:
    return F.explode(F.array(value))


def decode(bodies: DataFrame, feed: Feed, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed fields of every body plus ``reason``: NULL for a valid event, else why it is not one.

    All fields are required and non-null, further JSON fields are ignored.  The body is parsed as the first of two array
    elements, so that anything but exactly one JSON object (text after the object, a second object, an array) fails instead
    of being read in part.  A body that closes the array itself would hide what follows it; between plain brackets it does not count
    as one element.
    """
    shape = "array<struct<" + ", ".join(f"`{c.source}`: variant" for c in feed.columns) + ">>"
    parsed = F.from_json(F.concat(F.lit("["), F.col(body), F.lit(",{}]")), shape, {"allowSingleQuotes": "false"})
    alone = F.json_array_length(F.concat(F.lit("["), F.col(body), F.lit("]"))) == 1
    closes = F.col(body).contains("]")  # only such a body needs the second look
    objects = bodies.select(*keep, F.col(body).alias("body"), _once(F.when(~closes | alone, parsed)).alias("objects"))
    first = F.get(F.col("objects"), 0)
    values = F.struct(
        ((F.size("objects") == 2) & first.isNotNull()).alias("is_object"),
        *[
            F.struct(
                F.schema_of_variant(first[c.source]).alias("kind"),
                F.try_variant_get(first[c.source], "$", "string").alias("text"),
            ).alias(c.name)
            for c in feed.columns
        ],
    )
    read = objects.select(*keep, "body", _once(values).alias("value"))
    typed = read.select(
        *keep,
        "body",
        F.coalesce("value.is_object", F.lit(False)).alias("is_object"),
        *[coerce.BY_KIND[c.kind](F.col(f"value.{c.name}.kind"), F.col(f"value.{c.name}.text")).alias(c.name) for c in feed.columns],
    )
    bad = F.concat_ws(",", *[F.when(F.col(c.name).isNull(), F.lit(c.source)) for c in feed.columns])
    reason = F.when(~F.col("is_object"), F.lit("not a JSON object")).when(
        bad != "", F.concat(F.lit("missing or invalid: "), bad)
    )
    day = F.col(feed.date_field).cast("date")
    return typed.select(*typed.columns, day.alias("event_date"), reason.alias("reason"))


def _is_valid(feed: Feed) -> Column:
    return reduce(Column.__and__, [F.col(c.name).isNotNull() for c in feed.columns], F.col("is_object"))


def valid_events(decoded: DataFrame, feed: Feed, keep: tuple[str, ...] = ()) -> DataFrame:
    return decoded.where(_is_valid(feed)).select(*keep, *[c.name for c in feed.columns], "event_date")


def rejected_events(decoded: DataFrame, feed: Feed, keep: tuple[str, ...] = ()) -> DataFrame:
    return decoded.where(~_is_valid(feed)).select(*keep, "body", "reason")
