"""Casts of dirty text. A value that does not fit becomes null and never fails the batch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LONG_EDGE = float(2**63)


def lenient_cast(text: Column, data_type: T.DataType) -> Column:
    """Text to a metric type. Integers go by way of double and are truncated (``3.9`` gives 3)."""
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.IntegerType):
        number = text.try_cast("double")
        whole = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number))
        return F.when(number.between(INT_MIN, INT_MAX), whole).cast("int")
    if isinstance(data_type, T.LongType):
        number = text.try_cast("double")
        whole = F.when((number >= -LONG_EDGE) & (number < LONG_EDGE), number).cast("bigint")
        return F.coalesce(text.try_cast("bigint"), whole)
    return text.try_cast(data_type)
