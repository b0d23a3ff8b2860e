"""Landed files to raw tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, functions as F

from coinwharf.plans.lake import Lake
from coinwharf.schemas import RAW_COLUMNS
from coinwharf.sources.landing import load_plan, planned, read_raw, routed, stamped


def files_per_table(lake: Lake, files: DataFrame, config_path: str | None) -> list[Row]:
    """(table, write_mode, paths) per table with files; file names only, no contents."""
    plan = load_plan(lake.spark, config_path) if config_path else lake.default_plan()
    rows = planned(files, plan).select("table", "write_mode", "path").collect()
    paths: dict[tuple[str, str], list[str]] = {}
    for row in rows:
        paths.setdefault((row["table"], row["write_mode"]), []).append(row["path"])
    return [
        Row(table=table, write_mode=mode, paths=sorted(found)) for (table, mode), found in sorted(paths.items())
    ]


def skipped(files: DataFrame) -> DataFrame:
    """Files whose name belongs to no table."""
    return routed(files).where("table is null").drop("table")


def load_table(
    lake: Lake,
    entity: str,
    paths: Sequence[str],
    mode: str,
    load_id: str,
    run_ts: dt.datetime | str | None = None,
    headers: str = "by_name",
    infer: bool = False,
) -> DataFrame:
    """Read all files of a table together, stamp them and write them once.

    Written one by one under ``overwrite``, each file would erase the one before it.
    With ``infer`` the values are stored as the text of their inferred types. Returns this
    load's rows, read back from the raw table.
    """
    table = lake.raw(entity)
    rows = read_raw(lake.spark, paths, entity, headers, infer)
    if infer:
        rows = rows.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[entity]])
    table.save(stamped(rows, run_ts), mode, load_id)
    return table.rows_of(load_id)
