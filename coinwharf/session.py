"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "coinwharf", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings every job here expects (UTC, ANSI, adaptive execution)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named in ``spark.checkpoint.dir``.

    Only a local session may go without it; there a fresh folder is made and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="coinwharf-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/coinwharf/{label}-{uuid.uuid4().hex}"


#: Rows that a join may send to every task.
BROADCAST_ROWS = 100_000


def join_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as a side of a join that is broadcast only if it has few rows.

    The planner takes the size of compressed files for that of their rows, which can be many times
    as large: keys that it holds for 10 MB have filled the driver.
    """
    return df if rows <= BROADCAST_ROWS else df.hint("merge")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner real file sizes. These are
    compressed: a join of what may have many rows takes it as a :func:`join_side`.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}


def small_frame(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """A few rows of metadata (text, long and boolean columns) as a DataFrame.

    Handed over as one Arrow table, which spares the Python workers a plain list starts.
    """
    schema = StructType.fromDDL(ddl)
    names = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in schema])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], names), schema)


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema; Catalyst plans it away."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
