"""Arriving files and messages as streams that run the chain per micro-batch.

The checkpoint delivers each file once and replays a batch that failed. A run is named
after the query, whose id the checkpoint keeps, and the batch; every table skips a load
it has committed, so a replay changes nothing twice.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from coinwharf.plans.chain import Run, run_files
from coinwharf.plans.lake import Lake
from coinwharf.session import small_frame
from coinwharf.sources.notifications import decode_notifications

MAX_FILES = 1000
FILE_DDL = "path string, modificationTime timestamp, length long, content binary"


def file_arrivals(
    spark: SparkSession, landing: str, pattern: str = "*.csv", max_files: int = MAX_FILES
) -> DataFrame:
    """New files of a folder (path, modificationTime, length); contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_DDL)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path", "modificationTime", "length")
    )


def message_arrivals(spark: SparkSession, folder: str, scheme: str = "gs", max_files: int = MAX_FILES) -> DataFrame:
    """New messages of a folder of JSON lines, decoded to object paths; bad messages have none.

    A batch takes ``max_files`` message files at most.
    """
    messages = spark.readStream.schema("data string").option("maxFilesPerTrigger", max_files).json(folder)
    return decode_notifications(messages, scheme=scheme)


def start_chain(
    arrivals: DataFrame,
    lake: Lake,
    checkpoint: str,
    config_path: str | None = None,
    run_ts: dt.datetime | None = None,
    as_of: dt.date | None = None,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Run the chain for each micro-batch of a stream with a ``path`` column.

    ``available_now`` takes what is there and stops; otherwise the query goes on.
    """

    started: Future[StreamingQuery] = Future()

    def chain(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{started.result().id}-{batch_id:09d}"
        run = Run.of(run_id=run_id, run_ts=run_ts, as_of=as_of, **options)
        # Only names leave the batch, at most max_files of them: the jobs below run in the
        # caller's session, where adaptive execution is on.
        csv = F.col("path").endswith(".csv")
        names = batch.where(csv).select("path").distinct().collect()
        files = small_frame(lake.spark, names, "path string")
        refused = batch.where(~csv | F.col("path").isNull())
        counts = refused.agg(F.count_if(F.col("path").isNull()).alias("undecodable"), F.count("path").alias("not_csv")).first().asDict()
        noted = [("arrivals", "messages", counts)] if any(counts.values()) else []
        if noted:
            refused.write.mode("overwrite").parquet(f"{lake.rejects('arrivals')}/run_id={run_id}")
        run_files(lake, files, run, config_path, only_new=True, noted=noted)

    writer = arrivals.writeStream.foreachBatch(chain).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    started.set_result(query)
    return query
