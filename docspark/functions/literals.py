"""Python values as Spark literals of a field's type."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, functions as F, types as T


def compared(value, dtype: T.DataType) -> Column:
    """A value to compare with a field.

    Text is cast to the field's type, and fails the query if it cannot be. Numbers are
    compared as they are, so 5.5 never equals an integer field that holds 5; only
    a 4-byte float field compares in its own precision.
    """
    number = isinstance(value, (int, float, Decimal)) and not isinstance(value, bool)
    if number and isinstance(dtype, T.NumericType) and not isinstance(dtype, T.FloatType):
        return F.lit(value)
    return stored(value, dtype)


def stored(value, dtype: T.DataType) -> Column:
    """A value of exactly the field's type. A time without zone is UTC."""
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        # as text: a datetime literal would be read in the driver's time zone
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(dtype)
