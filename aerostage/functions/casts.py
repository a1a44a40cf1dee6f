"""Safe casts (P5-P9) and landed time-text parsing.

All are null-on-failure (``try_cast`` / ``try_to_timestamp``), never raise under ANSI mode, and are
independent of the session time zone: event times are kept as ``timestamp_ntz`` wall clocks.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double_text(c) -> Column:
    """``TRY_CAST(x::string AS FLOAT)``: ``''`` and junk give null."""
    return _c(c).cast("string").try_cast("double")


def try_long(c) -> Column:
    """Integer text or number to bigint, else null."""
    return _c(c).cast("string").try_cast("bigint")


def try_date(c) -> Column:
    return _c(c).cast("string").try_cast("date")


def epoch_to_timestamp(c) -> Column:
    """Epoch seconds (a number, or text read with ``try_long``) to a UTC wall-clock ``timestamp_ntz``
    (no session zone involved); null from 10**12 seconds on."""
    secs = _c(c) if not isinstance(c, str) else try_long(c)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=secs.try_cast("decimal(18,6)"))


# Date, time of day with optional seconds and fraction, and an optional offset (Z, +hh, +hhmm or +hh:mm).
_TIME_TEXT = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)(Z|[+-]\d{2}(?::?\d{2})?)?$"
_LARGEST_OFFSET = 18 * 60  # minutes


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _normalised(c) -> Column:
    return F.translate(F.trim(_c(c)), "T", " ")


def _clock(text: Column) -> Column:
    """Text that matches ``_TIME_TEXT``, up to its zone (``Z`` or a sign after the 16 characters of date, hour and minute) or the
    line end that the pattern lets pass."""
    rest = F.substring(text, 17, 1 << 30)
    for mark in "Z+-\u0085\u2028\u2029":
        rest = F.substring_index(rest, mark, 1)
    return F.concat(F.substring(text, 1, 16), rest)


# What the feed sends, by place: text of this length with its blank and zone there needs no clean-up, and its clock is cut by
# position. Any other text takes the long way; both are held to ``_TIME_TEXT``.
_CLOCK_LENGTH = 16
_UTC_AS_SENT = ("__________ _____Z",)
_LOCAL_AS_SENT = ("__________ _____+__:__", "__________ _____-__:__")


def _as_sent(c, forms: tuple[str, ...]) -> Column:
    return reduce(or_, [_c(c).like(form) for form in forms])


def _matching(c, as_sent: Column) -> Column:
    """Whether the cleaned text matches ``_TIME_TEXT``; a text as sent either matches as it is or not at all."""
    return F.when(as_sent, _c(c)).otherwise(_normalised(c)).rlike(_TIME_TEXT)


def parse_local_time(c) -> Column:
    """Time text of a ``*_local`` field to ``timestamp_ntz``: the wall clock, any offset dropped."""
    as_sent = _as_sent(c, _LOCAL_AS_SENT)
    clock = F.when(as_sent, F.substring(_c(c), 1, _CLOCK_LENGTH)).otherwise(_let(_normalised(c), _clock))
    return F.when(_matching(c, as_sent), clock).otherwise(_normalised(c)).try_cast("timestamp_ntz")


def parse_utc_time(c) -> Column:
    """Time text of a ``*_utc`` field to a UTC ``timestamp_ntz``.

    Decided by pattern: ``T`` or a blank between date and time, with or without seconds and their fraction,
    followed by ``Z``, a numeric offset (applied, so the result is UTC) or nothing. Anything else gives
    null. The offset is subtracted from the wall clock, so the session time zone plays no part.

    The pattern is matched once for a text; its parts are then cut out by position: matching it for each part and each use of
    one was most of the cost of a load.
    """
    def moved(clock: Column, zone: Column) -> Column:
        hours = F.coalesce(F.substring(zone, 2, 2).try_cast("int"), F.lit(0))
        minutes = F.coalesce(F.substring(zone, 4, 2).try_cast("int"), F.lit(0))
        sign = F.when(zone.startswith("-"), -1).otherwise(1)
        shift = lambda m: F.when(F.abs(m) <= _LARGEST_OFFSET, clock - F.make_dt_interval(mins=m))
        return F.when(zone.isin("", "Z"), clock).when(minutes < 60, _let((hours * 60 + minutes) * sign, shift))

    def parts(text: Column, clock: Column) -> Column:
        zone = F.replace(F.substring(text, F.length(clock) + 1, F.lit(1 << 30)), F.lit(":"), F.lit(""))
        return _let(zone, lambda z: moved(clock.try_cast("timestamp_ntz"), z))

    as_sent = _as_sent(c, _UTC_AS_SENT)
    other = _let(_normalised(c), lambda text: _let(_clock(text), lambda clock: parts(text, clock)))
    plain = F.substring(_c(c), 1, _CLOCK_LENGTH).try_cast("timestamp_ntz")
    return F.when(_matching(c, as_sent), F.when(as_sent, plain).otherwise(other))


def safe_cast(df, name: str, target) -> Column:
    """``try_cast`` of column ``name`` of ``df`` to ``target``, without a per-row text round trip when the
    column already has a compatible type (a date stays a date, an integer widens, a number becomes a
    double). Text goes through ``try_cast`` (junk gives null)."""
    from pyspark.sql import types as T

    if isinstance(target, str):
        target = {"bigint": T.LongType(), "date": T.DateType(), "double": T.DoubleType()}[target]
    src = df.schema[name].dataType
    c = F.col(name)
    if src == target:
        return c
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(target, T.LongType) and isinstance(src, integral):
        return c.cast(target)
    if isinstance(target, T.DoubleType) and isinstance(src, integral + (T.FloatType, T.DoubleType, T.DecimalType)):
        return c.cast(target)
    return c.cast("string").try_cast(target)


def unparsed_report(df, columns: dict):
    """Per time column, the non-null texts and how many of them parsed to null, in one aggregate pass.

    ``columns`` maps a report name to ``(text column, parsed column)``. Returns rows
    ``(column_name, texts, unparsed)``.
    """
    aggs = []
    for i, (text_col, parsed_col) in enumerate(columns.values()):
        t, p = F.col(text_col), F.col(parsed_col)
        aggs += [F.count(t).alias(f"t{i}"), F.count_if(t.isNotNull() & p.isNull()).alias(f"u{i}")]
    stack = ", ".join(f"'{name}', t{i}, u{i}" for i, name in enumerate(columns))
    return df.agg(*aggs).selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, texts, unparsed)")
