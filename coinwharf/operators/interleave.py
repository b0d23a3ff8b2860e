"""An order of rows by several columns at once.

Rows sorted by one column and then another are together in the first only. Here each column's values
are ranked by range, and the ranks' bits are interleaved, the highest of each column first: rows that
are near in this order are near in every column, so a file's row groups cover a small range of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

RANK_BITS = 6
#: Bounds that are written out as nested cases at most.
WRITTEN_OUT = 8
#: Rows that the bounds are taken from.
SAMPLE = 16_384
BOUNDS_DDL = "name string, rank bigint, bound string"


def bounds_of(df: DataFrame, columns: Sequence[str], sample: int = SAMPLE) -> list[tuple[str, int, str]]:
    """(column, rank, least text of that rank) of evenly filled ranks, from the rows of least hash."""
    rows = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    chosen = rows.orderBy(F.xxhash64(*columns)).limit(sample).toArrow().to_pydict()
    found = []
    for column in columns:
        values = sorted(v for v in chosen[column] if v is not None)
        ranks = 1 << RANK_BITS
        cuts = sorted({values[len(values) * i // ranks] for i in range(1, ranks)}) if values else []
        found += [(column, i, cut) for i, cut in enumerate(cuts)]
    return found


def _rank(value: Column, bounds: Sequence[str], least: int = 0) -> Column:
    """How many bounds a value reaches, halving them with each comparison; NULL reaches none."""
    if not bounds:
        return F.lit(least)
    middle = len(bounds) // 2
    reached = _rank(value, bounds[middle + 1 :], least + middle + 1)
    return F.when(value >= bounds[middle], reached).otherwise(_rank(value, bounds[:middle], least))


def _looked_up(value: Column, bounds: Sequence[str]) -> Column:
    """The same for many bounds, which are looked up in an array: as nested cases they make generated
    code that is too long for the JVM to compile. Past the last bound the look-up is NULL, which no
    value reaches."""
    rank, cuts = F.lit(0), F.array(*[F.lit(bound) for bound in bounds])
    for bit in reversed(range(len(bounds).bit_length())):
        rank = rank + F.when(value >= F.get(cuts, rank + ((1 << bit) - 1)), 1 << bit).otherwise(0)
    return rank


def interleaved(bounds: dict[str, Sequence[str]]) -> Column:
    """A number that orders rows by the interleaved bits of their columns' ranks."""
    columns = len(bounds)
    spread = F.array(*[F.lit(sum((rank >> bit & 1) << bit * columns for bit in range(RANK_BITS))).cast("bigint") for rank in range(1 << RANK_BITS)])
    place = F.lit(0).cast("bigint")
    for i, (column, cuts) in enumerate(bounds.items()):
        # few different values still use the highest bits
        reached = _rank if len(cuts) <= WRITTEN_OUT else _looked_up
        rank = F.floor(reached(F.col(column).cast("string"), cuts) * (1 << RANK_BITS) / (len(cuts) + 1)).cast("int")
        place = place + F.shiftleft(F.element_at(spread, rank + 1), columns - 1 - i)
    return place
