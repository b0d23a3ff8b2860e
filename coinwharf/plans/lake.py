"""Where the tables of each layer live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from coinwharf.plans.curated import ORDER_STAMPS, SPECS
from coinwharf.plans.reports import in_order
from coinwharf.schemas import ENTITIES, curated_schema, raw_schema
from coinwharf.session import small_frame
from coinwharf.sources.tables import SnapshotTable

#: Rows of a file of a raw table at most.
FILE_ROWS = 100_000


@dataclass(frozen=True)
class Lake:
    """Raw, curated, reporting and audit tables under one root folder."""

    spark: SparkSession
    root: str
    partition_raw_by_day: bool = False

    def raw(self, entity: str) -> SnapshotTable:
        """A load has one ingestion day, so its rows need no gathering. Files are packed into tasks by
        bytes, and some rows take few: with bounded files a task cannot get most of the rows."""
        day = ("ingestion_date", "ingestion_timestamp") if self.partition_raw_by_day else None
        root = f"{self.root}/rawlayer/{entity}"
        return SnapshotTable(self.spark, root, raw_schema(entity), day, gather=False, options={"maxRecordsPerFile": str(FILE_ROWS)})

    def curated(self, entity: str) -> SnapshotTable:
        spec = SPECS[entity]
        return SnapshotTable(
            self.spark,
            f"{self.root}/curated/{entity}",
            curated_schema(entity),
            spec.partition,
            spec.cluster,
            hidden=ORDER_STAMPS,
        )

    def summary(self, name: str, schema: StructType) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/summaries/{name}", schema)

    def report(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/reporting/{name}")

    def show_report(self, name: str) -> DataFrame:
        """A stored report in the order it is shown in."""
        return in_order(name, self.report(name).read())

    @property
    def audit(self) -> str:
        return f"{self.root}/auditlayer/audit_log"

    def rejects(self, entity: str) -> str:
        return f"{self.root}/auditlayer/rejects/{entity}"

    def default_plan(self) -> DataFrame:
        """Every table replaced by each load."""
        modes = [(entity, "overwrite") for entity in ENTITIES]
        return small_frame(self.spark, modes, "table string, write_mode string")
