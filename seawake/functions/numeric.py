"""Rounding that does not depend on the last bits of a double.

``round(x, n)`` of a double sits on a knife edge when ``x`` is a binary neighbour of a
decimal half (``1.005``): two engines that add the same numbers in another order can land
on different sides. Going through ``DECIMAL(38,10)`` first fixes the value at 10 decimals
(half-up), then the decimal is rounded half-up to ``n`` places, so the answer only depends
on the value, not on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c, n: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.try_cast("decimal(38,10)"), n).cast("double")
