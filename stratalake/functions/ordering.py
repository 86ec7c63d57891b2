"""Doubles as integers of the same order, exactly and back again.

An integer counts the doubles between zero and the value: exponent times 2**52 plus the leading
bits, negative for negative values. All scaling is by powers of two, so nothing is rounded.
"""

from __future__ import annotations

import struct
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 1 << 52  # doubles per power of two
_MIN_EXPONENT = -1022
_SMALLEST = 5e-324
_INFINITE = float("inf")


def _power(exponent: Column) -> Column:
    """2**exponent for -1022 to 1024: a multiple of 32 from a table, the rest by shifting."""
    coarse = F.array(*[F.lit(2.0 ** e) for e in range(-1024, 1024, 32)], F.lit(_INFINITE))
    fine = F.call_function("shiftleft", F.lit(1).cast("bigint"), exponent.bitwiseAND(31))
    return coarse[F.shiftright(exponent, 5) + 32] * fine.cast("double")


def double_to_rank(value: Column) -> Column:
    """BIGINT rank of a DOUBLE; NULL for NULL and NaN, 0 for both zeros."""
    size = F.abs(value)
    # Zero and infinity are ranked one step beside their neighbours.
    inside = F.greatest(F.least(size, F.lit(sys.float_info.max)), F.lit(_SMALLEST))
    beside = (size == _INFINITE).cast("bigint") - (size == 0).cast("bigint")
    # The logarithm is not exact next to a power of two: stay below it, then compare.
    low = F.greatest(F.floor(F.log2(inside) - 1e-9).cast("int"), F.lit(_MIN_EXPONENT))
    exponent = low + (inside >= _power(low + 1)).cast("int")
    rank = (exponent - _MIN_EXPONENT).cast("bigint") * _STEPS + (
        inside / _power(exponent) * float(_STEPS)
    ).cast("bigint") + beside
    return rank * F.when(F.isnan(value), None).when(value < 0, -1).otherwise(1)


def rank_to_double(rank: Column) -> Column:
    size = F.abs(rank)
    exponent = F.greatest(F.shiftright(size, 52) - 1, F.lit(0))
    steps = (size - exponent * _STEPS).cast("double")
    value = steps / float(_STEPS) * _power((exponent + _MIN_EXPONENT).cast("int"))
    return value * F.when(rank < 0, -1).otherwise(1)


def double_of_rank(rank: int) -> float:
    """The same for one number on the driver; beyond the infinities, NaN."""
    (value,) = struct.unpack("<d", struct.pack("<Q", min(abs(rank), (1 << 63) - 1)))
    return -value if rank < 0 else value
