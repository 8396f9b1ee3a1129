"""Tolerant type coercion under ANSI mode (bad input -> NULL, never an error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    x = _c(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def to_double(c) -> Column:
    """``pd.to_numeric(errors='coerce')`` as double: text that does not parse and
    NaN both become NULL."""
    return nan_to_null(_c(c).try_cast("double"))


def to_decimal(c, precision: int = 12, scale: int = 2, default=None) -> Column:
    """Coerce to decimal(p,s). What is missing or not a number becomes ``default``
    (NULL if not given); a number too large for the type becomes NULL, never the
    default, so that a load can reject it."""
    kind = f"decimal({precision},{scale})"
    x = _c(c).try_cast(kind)
    if default is None:
        return x
    return F.when(to_double(c).isNull(), F.lit(default).cast(kind)).otherwise(x)


def to_int(c, default=None) -> Column:
    """Python ``int(x)`` with fallback: whole numbers pass, also as text with a
    decimal point ('5.0', as a reader with numeric columns sees it); other text
    -> NULL (then ``default``)."""
    number = _c(c).try_cast("decimal(38,6)")
    x = F.coalesce(_c(c).try_cast("int"), F.when(number == F.floor(number), number.try_cast("int")))
    return F.coalesce(x, F.lit(default)) if default is not None else x


def clip_rating(c, lo: float = 1.0, hi: float = 5.0, missing: float = 3.0) -> Column:
    """``to_numeric(errors='coerce').clip(lo, hi).fillna(missing)``.

    ``greatest``/``least`` skip NULL, so the NULL case is handled first.
    """
    x = to_double(c)
    return (F.when(x.isNull(), F.lit(missing))
             .otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), x))))


# Patterns tried after ISO, in this order (month before day, as pandas reads them).
DATE_FORMATS = ["M/d/yyyy", "yyyyMMdd", "MMM d yyyy", "MMM d, yyyy", "d MMM yyyy", "yyyy/M/d"]


def to_date(c, fmt: str | None = None) -> Column:
    """``pd.to_datetime(errors='coerce')`` to a date: ISO, then DATE_FORMATS;
    bad -> NULL."""
    return to_timestamp(c, fmt).cast("date")


def to_timestamp(c, fmt: str | None = None) -> Column:
    """As to_date, with the time where the text has one ('T' or blank before it)."""
    x = _c(c)
    if fmt:
        return F.try_to_timestamp(x, F.lit(fmt)).cast("timestamp_ntz")
    text = F.trim(x.cast("string"))
    more = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in DATE_FORMATS]
    return F.coalesce(x.try_cast("timestamp_ntz"), *more)
