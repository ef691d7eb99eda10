"""Lax type coercion of JSON values, as column expressions.

A JSON value comes as two strings: its kind (``STRING``, ``BIGINT``, ``DECIMAL(p,s)``, ``DOUBLE``, ``BOOLEAN``, ...) and its
text.  Each function turns them into a typed column that is NULL when the value is not acceptable.  The accepted forms are
those of a lax validating model, not those of a SQL cast: an integer field takes ``5``, ``5.0``, ``"5"``, ``" 5 "``,
``"1_000"`` and ``true`` but not ``5.5``; a string field takes only JSON strings; a timestamp takes ISO text or epoch numbers.
Nothing here depends on the session time zone.

The usual form of each type is tested first, inline; all other forms are evaluated inside a lambda (``_other_forms``), which
keeps their code out of the compiled path of the usual one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms.
INT_TEXT = r"^\s*[+-]?(0[0_]*(?=[0-9]))?[0-9]+(_[0-9]+)*(\.0+)?\s*$"
FLOAT_TEXT = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"
SINGLE_UNDERSCORES = r"^(?!_)(?!.*__)(?!.*_$)\S+$"
DATE_TEXT = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}$"
PLAIN_TIME_TEXT = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?)?$"
LOCAL_TIME_TEXT = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}([Tt _][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,9})?)?)?$"
ZONED_TIME_TEXT = (
    r"^(?!0000)([0-9]{4}-[0-9]{2}-[0-9]{2}[Tt _][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]{1,9})?)?)"
    r"(?:[Zz]|([+-])([01][0-9]|2[0-3]):?([0-5][0-9]))$"
)
EPOCH_TEXT = r"^[+-]?([0-9]{1,18}\.?[0-9]*|\.[0-9]+)$"
EPOCH_MILLIS_FROM = 20_000_000_000  # an epoch number beyond this is milliseconds, not seconds
EPOCH_MILLIS_MIN = -62_135_596_800_000  # 0001-01-01
EPOCH_MILLIS_MAX = 253_402_300_799_999  # 9999-12-31


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")


def _other_forms(kind: Column, text: Column, convert: Callable[[Column, Column], Column]) -> Column:
    value = F.struct(kind.alias("kind"), text.alias("text"))
    return F.get(F.transform(F.array(value), lambda v: convert(v["kind"], v["text"])), 0)


def to_string(kind: Column, text: Column) -> Column:
    return F.when(kind == "STRING", text)


def to_long(kind: Column, text: Column) -> Column:
    return F.when(kind == "BIGINT", text.try_cast("bigint")).otherwise(_other_forms(kind, text, _long_of_other))


def _long_of_other(kind: Column, text: Column) -> Column:
    digits = F.regexp_extract(F.translate(text, "_ \t\r\n\f", ""), r"^([+-]?[0-9]+)", 1)
    exact, approx = text.try_cast("decimal(38,18)"), text.try_cast("double")
    return (
        F.when(kind == "STRING", F.when(text.rlike(INT_TEXT), digits.try_cast("bigint")))
        .when(kind == "BOOLEAN", (text == "true").cast("bigint"))
        .when(kind.startswith("DECIMAL"), F.when(exact == F.floor(exact), exact.try_cast("bigint")))
        .when(kind == "DOUBLE", F.when(approx == F.rint(approx), approx.try_cast("bigint")))
    )


def to_double(kind: Column, text: Column) -> Column:
    return F.when(_is_number(kind), text.try_cast("double")).otherwise(_other_forms(kind, text, _double_of_other))


def _double_of_other(kind: Column, text: Column) -> Column:
    digits = F.translate(text, "_", "")
    return (
        F.when((kind == "STRING") & text.rlike(FLOAT_TEXT), text.try_cast("double"))
        .when((kind == "STRING") & text.rlike(SINGLE_UNDERSCORES) & digits.rlike(FLOAT_TEXT), digits.try_cast("double"))
        .when(kind == "BOOLEAN", (text == "true").cast("double"))
    )


def _local_time(text: Column) -> Column:
    """ISO text without offset; blank, ``_`` and ``t`` separate date and time, ``,`` may stand for the decimal point."""
    with_time = F.overlay(F.translate(text, ",", "."), F.lit("T"), F.lit(11), F.lit(1))
    return F.when(F.length(text) > 10, with_time).otherwise(text).try_cast("timestamp_ntz")


def _offset(text: Column) -> Column:
    """The offset of zoned text as an interval; zero for ``Z``."""
    sign, hours, minutes = (F.regexp_extract(text, ZONED_TIME_TEXT, i) for i in (2, 3, 4))
    direction = F.when(sign == "-", -1).otherwise(1)
    part = [F.coalesce(p.try_cast("int"), F.lit(0)) * direction for p in (hours, minutes)]
    return F.make_dt_interval(F.lit(0), part[0], part[1])


def _epoch_time(text: Column) -> Column:
    """Epoch seconds or milliseconds as UTC time."""
    number = text.try_cast("double")
    exact = text.try_cast("decimal(38,9)")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def after_start(seconds):
        return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))

    return F.when(F.abs(number) <= EPOCH_MILLIS_FROM, after_start(exact)).when(
        number.between(EPOCH_MILLIS_MIN, EPOCH_MILLIS_MAX), after_start(exact / 1000)
    )


def to_timestamp(kind: Column, text: Column) -> Column:
    """UTC time of ISO text (with or without offset) or of an epoch number."""
    plain = (kind == "STRING") & text.rlike(PLAIN_TIME_TEXT)
    return F.when(plain, text.try_cast("timestamp_ntz")).otherwise(_other_forms(kind, text, _time_of_other))


def _time_of_other(kind: Column, text: Column) -> Column:
    zoned = _local_time(F.regexp_extract(text, ZONED_TIME_TEXT, 1)) - _offset(text)
    return (
        F.when((kind == "STRING") & text.rlike(LOCAL_TIME_TEXT), _local_time(text))
        .when((kind == "STRING") & text.rlike(ZONED_TIME_TEXT), zoned)
        .when(_is_number(kind) | ((kind == "STRING") & text.rlike(EPOCH_TEXT)), _epoch_time(text))
    )


def to_date(kind: Column, text: Column) -> Column:
    """A date, or a moment at exactly midnight (by its own clock when it carries an offset)."""
    plain = (kind == "STRING") & text.rlike(DATE_TEXT)
    return F.when(plain, text.try_cast("date")).otherwise(_other_forms(kind, text, _date_of_other))


def _date_of_other(kind: Column, text: Column) -> Column:
    own_clock = F.when(text.rlike(ZONED_TIME_TEXT), F.regexp_extract(text, ZONED_TIME_TEXT, 1)).otherwise(text)
    moment = _time_of_other(kind, own_clock)
    return F.when(moment == F.date_trunc("day", moment), moment.cast("date"))


BY_KIND: dict[str, Callable[[Column, Column], Column]] = {
    "STRING": to_string,
    "INT": lambda kind, text: to_long(kind, text).try_cast("int"),
    "LONG": to_long,
    "DOUBLE": to_double,
    "TIMESTAMP": to_timestamp,
    "DATE": to_date,
}
