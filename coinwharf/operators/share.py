"""Share of a grand total."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from coinwharf.functions.numeric import percent_of


def with_percentage(groups: DataFrame, value: str, name: str) -> DataFrame:
    """Add each row's percentage of the sum of ``value`` over all rows.

    The total is a scalar subquery over the already grouped rows, which Spark answers
    from the same shuffle files. A window over the whole set would move every group
    into one task instead.
    """
    total = groups.agg(F.sum(value).cast("double")).scalar()
    return groups.withColumn(name, percent_of(F.col(value).cast("double"), total))
