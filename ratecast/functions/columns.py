"""Column expressions (scalar functions).

All of them are compositions of Spark built-ins, so they stay inside
whole-stage codegen. None reads the session time zone: timestamps are
handled as TIMESTAMP_NTZ (UTC wall time) through epoch arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def epoch_ntz() -> Column:
    """``TIMESTAMP_NTZ '1970-01-01 00:00:00'`` (built on call: modules stay importable on workers)."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# Format of the `date_str` column: year month day hour minute second, no separators.
DATE_STR_FORMAT = "yyyyMMddHHmmss"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_offset(ts: ColumnOrName) -> Column:
    """Exact seconds since 1970-01-01 of a TIMESTAMP_NTZ, as DECIMAL(20,6).

    NTZ minus NTZ is a plain DAY TO SECOND interval, independent of the session
    time zone (``timestamp_diff`` on NTZ values is not: it goes through local
    instants, which shifts wall times around a daylight-saving change).
    """
    return (_col(ts) - epoch_ntz()).cast("interval second").cast("decimal(20,6)")


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ, rounded down.

    Sub-second precision is floored (so 1969-12-31 23:59:59.5 -> -1), which is
    how UNIX_SECONDS behaves.
    """
    return F.floor(epoch_offset(ts)).cast("long")


def from_epoch_seconds(secs: ColumnOrName) -> Column:
    """Inverse of :func:`epoch_seconds`, giving TIMESTAMP_NTZ."""
    return F.timestamp_add("SECOND", _col(secs), epoch_ntz())


def tumble_seconds(ts: ColumnOrName, width_seconds: int) -> Column:
    """Start of the tumbling bucket of ``ts`` as epoch seconds.

    Bucketing truncates toward zero (``%`` keeps the dividend's sign), so
    times before 1970 round up toward the epoch: -1 s with a 3600 s width
    lands on 0 (1970-01-01 00:00).
    """
    s = epoch_seconds(ts)
    return s - s % F.lit(int(width_seconds)).cast("long")


def tumble_interval(ts: ColumnOrName, width_seconds: int) -> Column:
    """Start of the tumbling bucket of ``ts`` (TIMESTAMP_NTZ)."""
    return from_epoch_seconds(tumble_seconds(ts, width_seconds))


def date_str(ts: ColumnOrName) -> Column:
    """``yyyyMMddHHmmss`` text of a timestamp."""
    return F.date_format(_col(ts), DATE_STR_FORMAT)


def ieee_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """IEEE-754 division: x/0 gives +Inf or -Inf, 0/0 and NaN/0 give NaN.

    Plain ``/`` raises on a zero divisor under ANSI mode and ``try_divide``
    returns NULL, so the zero case is spelled out. NULL in, NULL out.
    """
    a, b = _col(a).cast("double"), _col(b).cast("double")
    on_zero = (
        F.when(a > 0, F.lit(float("inf")))
        .when(a < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(b == 0, on_zero).otherwise(a / b)


def variant_scalar(v: ColumnOrName) -> Column:
    """Text of a scalar VARIANT; NULL for an object, an array or a JSON null.

    Decided by the value's type, so a string that looks like JSON stays a string.
    """
    v = _col(v)
    nested = F.schema_of_variant(v).startswith("OBJECT") | F.schema_of_variant(v).startswith("ARRAY")
    return F.when(~nested, F.try_variant_get(v, "$", "string"))


def json_scalar(doc: ColumnOrName, path: str = "$") -> Column:
    """Scalar at ``path`` as text; NULL for objects, arrays, bad JSON or a missing key."""
    return variant_scalar(F.try_variant_get(F.try_parse_json(_col(doc)), path, "variant"))


def json_array(doc: ColumnOrName, path: str) -> Column:
    """Scalars of the array at ``path`` as ``array<string>``; objects and arrays inside it are NULL.

    Missing key, non-array value or bad JSON give NULL.
    """
    return F.transform(F.try_variant_get(F.try_parse_json(_col(doc)), path, "array<variant>"), variant_scalar)


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN becomes NULL; other values pass through."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def linear_interpolate(pos: ColumnOrName, prev: ColumnOrName, next_: ColumnOrName) -> Column:
    """y on the line through ``prev`` and ``next`` at ``pos``.

    ``prev``/``next`` are structs ``<x: long, y: double>``; NULL if either is NULL.
    Operation order is fixed: ``(ny - py) / (nx - px) * (pos - px) + py``.
    """
    pos, prev, next_ = _col(pos), _col(prev), _col(next_)
    px, py = prev.getField("x"), prev.getField("y")
    nx, ny = next_.getField("x"), next_.getField("y")
    line = (ny - py) / (nx - px).cast("double") * (pos - px).cast("double") + py
    return F.when(prev.isNull() | next_.isNull(), F.lit(None).cast("double")).otherwise(line)


def interpolate_or_fill(value: ColumnOrName, pos: ColumnOrName, prev: ColumnOrName,
                        next_: ColumnOrName, default) -> Column:
    """Known value if present, ``default`` at an open end, else the line between neighbours.

    ``pos`` and the neighbours' ``x`` are epoch seconds.
    """
    value = _col(value)
    prev, next_ = _col(prev), _col(next_)
    dflt = F.lit(default).cast("double") if not isinstance(default, Column) else default
    return (
        F.when(value.isNotNull(), value)
        .when(prev.isNull() | next_.isNull(), dflt)
        .otherwise(linear_interpolate(pos, prev, next_))
    )

