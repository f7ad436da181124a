"""Join conditions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_keys(nullable: Sequence[str], plain: Sequence[str] = ()) -> Column:
    """Match ``key`` with ``_key``; null keys match each other for ``nullable`` ones."""
    tests = [F.col(k) == F.col(f"_{k}") for k in plain]
    tests += [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in nullable]
    return reduce(lambda a, b: a & b, tests)
