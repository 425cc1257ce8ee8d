"""Labels by threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tier(value: Column, steps: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first step whose floor ``value`` reaches, else ``rest``.

    ``steps`` run from the highest floor down. NULL falls to ``rest``, as in a
    CASE expression.
    """
    (floor, label), *more = steps
    picked = F.when(value >= floor, F.lit(label))
    for floor, label in more:
        picked = picked.when(value >= floor, F.lit(label))
    return picked.otherwise(F.lit(rest))
