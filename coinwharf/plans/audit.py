"""The audit log: exact counts for every step of a load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from coinwharf.functions.temporal import instant_literal
from coinwharf.plans.curated import CuratedSpec, accepted_rows, classified
from coinwharf.schemas import AUDIT_DDL
from coinwharf.session import small_frame


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per upsert action."""
    return merged.groupBy("action").agg(F.count("*").alias("rows"))


def quality_counts(raw: DataFrame, spec: CuratedSpec, null_keys: bool = False) -> DataFrame:
    """One row: rows read, rows without a required field, and unreadable values per typed column."""
    return verdict_counts(classified(raw, spec, null_keys=null_keys), spec)


def verdict_counts(rows: DataFrame, spec: CuratedSpec) -> DataFrame:
    """The same of classified rows.

    A plain aggregate instead of an observed metric: metrics are counted again when a task
    is retried, and the log has to be exact.
    """
    unreadable = [
        F.count_if(F.col("_unreadable").bitwiseAND(F.lit(1 << bit)) > 0).alias(f"unreadable_{name}")
        for bit, name in enumerate(spec.typed)
    ]
    return rows.agg(F.count("*").alias("rows_in"), F.count_if(F.size("_missing") > 0).alias("rejected"), *unreadable)


def collapsed_keys(rows: DataFrame, spec: CuratedSpec) -> DataFrame:
    """One row: how many keys came in more than one spelling, as ``A-1`` and ``A1`` do.

    Each task keeps the first and last spelling of a key, so a key of many rows is sent once a task.
    """
    spellings = accepted_rows(rows).groupBy(spec.key).agg((F.min("_spelled") != F.max("_spelled")).alias("several"))
    return spellings.agg(F.count_if(F.col(spec.key).isNotNull() & F.col("several")).alias("collapsed"))


def rejected_rows(raw: DataFrame, spec: CuratedSpec, null_keys: bool = False) -> DataFrame:
    """Raw rows that curation leaves out, with the columns they lack."""
    return refused(classified(raw, spec, null_keys=null_keys))


def refused(rows: DataFrame) -> DataFrame:
    """The same of classified rows."""
    return rows.where(F.size("_missing") > 0).select("_raw.*", F.col("_missing").alias("missing"))


def write_log(
    spark: SparkSession,
    folder: str,
    run_id: str,
    entries: Iterable[tuple[str, str, Mapping[str, int]]],
    run_ts: dt.datetime | str | None = None,
) -> None:
    """Write a run's (step, entity, counts) entries, one row per metric.

    Each run owns one folder, so a repeated run replaces its own entries. Counts that only
    the first attempt has (a load that is in a table already is not merged again) are kept.
    """
    path = f"{folder}/run_id={run_id}"
    found = {
        (step, entity, metric): int(count)
        for step, entity, counts in entries
        for metric, count in counts.items()
    }
    try:
        before = spark.read.parquet(path).collect()  # a few counts
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        before = []
    found = {(r["step"], r["entity"], r["metric"]): r["rows"] for r in before} | found
    rows = [(*key, count) for key, count in found.items()]
    log = small_frame(spark, rows, "step string, entity string, metric string, rows long")
    log.withColumn("logged_at", instant_literal(run_ts)).coalesce(1).write.mode("overwrite").parquet(path)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """All entries of all runs."""
    schema = StructType.fromDDL(AUDIT_DDL)
    return spark.read.schema(schema).parquet(folder).select(*schema.names)
