"""The job's configuration document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

# The parts of the document that describe where files land and raw tables.
SETTINGS_DDL = (
    "storage struct<raw_bucket: string, raw_folder: string>, "
    "bigquery struct<partition_column: string, partition_type: string>"
)


@dataclass(frozen=True)
class JobSettings:
    """Where files land, and whether raw tables are partitioned by day of ingestion."""

    landing: str | None
    partition_raw_by_day: bool


def job_settings(spark: SparkSession, config_path: str, scheme: str = "gs") -> JobSettings:
    """Read the parts of the document that describe the whole job (one small row)."""
    row = spark.read.schema(SETTINGS_DDL).option("multiLine", True).json(config_path).first()
    storage, raw = row["storage"], row["bigquery"]
    landing = f"{scheme}://{storage['raw_bucket']}/{storage['raw_folder'] or ''}" if storage else None
    by_day = bool(raw and raw["partition_type"] == "DAY" and raw["partition_column"] == "ingestion_timestamp")
    return JobSettings(landing, by_day)
