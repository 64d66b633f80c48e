"""Sizes of variable-length integers: seven payload bits per byte."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def varint_width(value: Column) -> Column:
    """Bytes that a non-negative BIGINT takes: one, plus one for each further seven bits in use."""
    steps = [(value >= F.lit(1 << bits)).cast("bigint") for bits in range(7, 63, 7)]
    return reduce(lambda total, step: total + step, steps, F.lit(1).cast("bigint"))
