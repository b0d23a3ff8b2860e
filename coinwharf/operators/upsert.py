"""Update matched rows, insert the others, keep the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

KEEP, UPDATE, INSERT = "keep", "update", "insert"


class DuplicateSourceKeys(ValueError):
    """The source of an upsert holds a key more than once."""


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a non-null key occurs more than once in ``source``."""
    present = reduce(and_, [F.col(key).isNotNull() for key in keys])
    repeated = source.where(present).groupBy(*keys).count().where("count > 1").limit(5).collect()
    if repeated:
        shown = ", ".join(str(row[: len(keys)]) for row in repeated)
        raise DuplicateSourceKeys(f"source keys are not unique, for example {shown}")


def _renamed(source: DataFrame) -> DataFrame:
    return source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("s_"))


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(key) == F.col(f"s_{key}") for key in keys])


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_match: Sequence[str], before: Sequence[str] = ()
) -> DataFrame:
    """The merged rows and what happened to each (``action``: keep, update or insert).

    ``source`` has the columns of ``target`` and unique keys. A matched row takes the
    ``on_match`` columns from the source and keeps its others; a source row without a match
    is inserted whole; a target row without a match stays as it is. Null keys never match.
    One full outer equi join: either side is read and shuffled once. The target may have more
    columns, which stay as they are; ``before`` names those whose values before an update are
    returned as well (``before_...``).
    """
    joined = target.withColumn("t_", F.lit(True)).join(_renamed(source), _same_key(keys), "full_outer")
    in_target, in_source = F.col("t_").isNotNull(), F.col("s_").isNotNull()

    def settled(name: str) -> Column:
        if name not in source.columns:
            return F.col(name)
        old, new = F.col(name), F.col(f"s_{name}")
        if name in on_match:
            return F.when(in_source, new).otherwise(old).alias(name)
        return F.when(in_target, old).otherwise(new).alias(name)

    action = F.when(~in_source, KEEP).when(in_target, UPDATE).otherwise(INSERT)
    replaced = [F.when(in_target & in_source, F.col(c)).alias(f"before_{c}") for c in before]
    return joined.select(*[settled(c) for c in target.columns], action.alias("action"), *replaced)


def apply_updates(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_match: Sequence[str]
) -> DataFrame:
    """The target's rows with the ``on_match`` columns of their source row, if they have one.

    The update half of :func:`merge_upsert`; a left join, so a small source is broadcast
    and the target is not shuffled.
    """
    joined = target.join(_renamed(source), _same_key(keys), "left_outer")
    matched = F.col("s_").isNotNull()
    return joined.select(
        *[
            F.when(matched, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) if c in on_match else F.col(c)
            for c in target.columns
        ]
    )


def outranks(newest: Sequence[str]) -> Column:
    """1 if the source's row (columns ``s_...``) comes after the target's by these columns in turn,
    NULL least; 0 if they are equal; else -1."""
    old, new = F.struct(*newest), F.struct(*[F.col(f"s_{c}").alias(c) for c in newest])
    return F.when(new > old, 1).when(new == old, 0).otherwise(-1)


def images(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_match: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Some columns of each matched row before (``sign`` -1) and after (1) the update."""
    joined = target.join(_renamed(source), _same_key(keys))

    def side(name: str, after: bool) -> Column:
        return (F.col(f"s_{name}") if after and name in on_match else F.col(name)).alias(name)

    both = [F.struct(*[side(c, sign > 0) for c in columns], F.lit(sign).alias("sign")) for sign in (-1, 1)]
    return joined.select(F.inline(F.array(*both)))


def merged_images(merged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same from rows of :func:`merge_upsert` (``before`` with these columns), and 1 for each inserted row."""
    old = F.struct(*[F.col(f"before_{c}").alias(c) for c in columns], F.lit(-1).alias("sign"))
    new = F.struct(*columns, F.lit(1).alias("sign"))
    sides = F.when(F.col("action") == UPDATE, F.array(old, new)).otherwise(F.array(new))
    return merged.where(F.col("action") != KEEP).select(F.inline(sides))
