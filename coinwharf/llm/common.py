"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

import coinwharf
from coinwharf.session import staged

#: Bytes of whole texts that Python works on at a time, so that a task needs little memory.
SLICE_BYTES = 4_000_000
#: Bytes of rows that a task hands to Python at a time; the session's own setting, if smaller, stays.
BATCH_BYTES = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, as ``id`` and ``text``; a null text is empty.

    All other columns are left out first, so none of their names can clash.
    """
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts together have about ``size`` bytes (one text at least).

    Memory that Arrow's pool keeps after a run is given back before the next one, so that workers
    that stay alive from stage to stage do not hold what only one of them needed.
    """
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.binary_length(batch.column(column)).fill_null(0), np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, end - start)
            start = end
            pa.default_memory_pool().release_unused()


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """``slices`` with their texts."""
    for batch in slices(batches, column):
        yield batch, batch.column(column).to_pylist()


def hot_values(df: DataFrame, column: str, share: float = 0.001) -> DataFrame:
    """Values that hold more than ``share`` of all rows: 1/share of them at most, at any size."""
    counts = df.groupBy(column).agg(F.count("*").alias("rows"))
    total = df.agg(F.count("*").alias("all_rows"))
    least = total.first()["all_rows"] * share
    return counts.where(F.col("rows") > F.lit(max(least, 1))).select(column)


#: Ids (8 bytes each) that may go to every executor; more are joined by shuffle.
MAX_SENT_IDS = 1_000_000


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows, all columns, whose id is not among ``ids`` (one column); a null id is never."""
    gone = staged(ids.select(ids[ids.columns[0]].alias("gone_id")).where("gone_id is not null").distinct(), "gone")
    if gone.count() <= MAX_SENT_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")


def with_row_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written with a key each, and the key's column: ids may repeat or be null, and a
    key that is not written may change when it is computed again."""
    key = "row_key"
    while key in map(str.lower, docs.columns):
        key += "_"
    return staged(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def _bytes(size: str) -> int:
    """A setting such as ``64MB`` in bytes."""
    number = size.lower().rstrip("ib")
    power = "kmgt".find(number[-1]) + 1
    return int(number[:-1] if power else number) << 10 * power


def reach_workers(spark: SparkSession) -> None:
    """Sends this package to the executors where their path does not have it, and bounds the
    batches that tasks hand to Python, which hold thousands of texts otherwise."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark.conf.get(setting)) > BATCH_BYTES:
        spark.conf.set(setting, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.abspath(coinwharf.__file__)))
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    sent = spark.sparkContext._python_includes
    if root in map(os.path.abspath, places) or any(os.path.basename(f) == "coinwharf.zip" for f in sent):
        return
    zipped = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="run-"), "coinwharf"), "zip", root, "coinwharf")
    spark.sparkContext.addPyFile(zipped)
