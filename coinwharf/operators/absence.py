"""Rows without a partner."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def without_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; null keys have no match.

    The right side is reduced to distinct keys before it is shuffled, so a key that
    fills a third of it arrives as one row per task.
    """
    known = reduce(and_, [F.col(key).isNotNull() for key in keys])
    present = right.where(known).select(*keys).distinct()
    return left.join(present, list(keys), "left_anti")
