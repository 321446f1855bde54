"""Rounding, guarded division and text-to-number conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_away(value: Column) -> Column:
    """Nearest whole double, exact halves away from zero (up to 9e18).

    Plain double arithmetic, short enough to be compiled to machine code;
    Spark's ``round`` goes through a decimal object per value.
    """
    return F.signum(value) * F.floor(F.abs(value) + 0.5)


def round_scaled(value: Column | str, digits: int) -> Column:
    """Scale, round half away from zero, scale back.

    Spark's own ``round(double, n)`` rounds the decimal text of the number, so
    1.005 becomes 1.01; here the product 100.49999… is what is rounded. Adding
    0.0 turns a negative zero into zero.
    """
    scale = float(10**digits)
    return half_away(_col(value).cast("double") * scale) / scale + F.lit(0.0)


def round_stable(value: Column | str, digits: int) -> Column:
    """``round_scaled`` for results of floating-point sums.

    The last bits of such a sum depend on the order of the rows, hence on the
    partitioning. Noise below 1e-6 of the last digit is removed first, so an
    exact half always rounds the same way on any cluster layout.
    """
    scale, noise = float(10**digits), 1e6
    quiet = F.rint(_col(value).cast("double") * scale * noise) / noise
    return half_away(quiet) / scale + F.lit(0.0)


def safe_ratio(top: Column | str, bottom: Column | str, digits: int | None = None) -> Column:
    """``top / bottom``, NULL on a zero denominator, optionally rounded."""
    ratio = _col(top).cast("double") / F.nullif(_col(bottom).cast("double"), F.lit(0.0))
    return ratio if digits is None else round_scaled(ratio, digits)


def try_double(text: Column | str) -> Column:
    return _col(text).try_cast("double")


def try_bigint(text: Column | str) -> Column:
    """Whole number from text: '12.7' is 13, '1e3' is 1000, junk is NULL.

    Plain digits take the cheap cast; only the others go through a decimal.
    """
    text = _col(text)
    via_decimal = F.round(text.try_cast("decimal(38,10)"), 0).try_cast("bigint")
    return F.coalesce(text.try_cast("bigint"), via_decimal)


def _required(text: Column | str, parsed: Column, kind: str) -> Column:
    text = _col(text)
    message = F.concat(F.lit(f"not a {kind}: "), text.cast("string"))
    return F.when(parsed.isNull() & text.isNotNull(), F.raise_error(message)).otherwise(parsed)


def strict_bigint(text: Column | str) -> Column:
    """``try_bigint`` that fails the job on text that is not a number."""
    return _required(text, try_bigint(text), "number")


def strict_double(text: Column | str) -> Column:
    return _required(text, try_double(text), "number")
