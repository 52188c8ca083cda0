"""Small column helpers shared by the operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Column from a column or a column name."""
    return c if isinstance(c, Column) else F.col(c)


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime or ISO text."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def let(value, use) -> Column:
    """``use(v)`` with ``value`` computed once, however often ``use`` names it
    (a plain expression would be copied, and evaluated, at each place)."""
    return F.transform(F.array(as_col(value)), use)[0]
