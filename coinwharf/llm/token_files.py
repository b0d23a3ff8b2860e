"""Token ids in ORC files: sorted by document, integer run lengths, row indexes, Bloom filters.

``write_tokens`` encodes whole texts and lets Spark's ORC writer store one row per document:
``part``, ``row`` (place in the part), ``doc_id``, ``start_in_part`` (ids before it in the
part), ``n_tokens`` and ``ids``. ORC run-length encodes the integers of each stripe, keeps
minima and maxima per row group, and here also a Bloom filter on the document ids, so a look-up
by id reads few stripes. Readers take stripes in parallel. Only ``n_tokens`` and
``start_in_part`` are read to find where a part begins in the whole sequence, never the ids.

Defined cases: a null text is empty and has the end id only; a null id sorts first; rows with
equal ids stay separate, ordered by a hash of their text, then as they were read, so that equal
rows need not share a part; an empty table gives
files without rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from coinwharf.llm.common import id_and_text, slices
from coinwharf.llm.tokens import encoder

STORED = "part int, row long, doc_id long, start_in_part long, n_tokens long, ids array<int>"
OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "1000",  # the least; some MB of ids
    "orc.stripe.size": str(64 << 20),
}


def _encode(path: str, end_id: int, keeps_blanks: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, start = TaskContext.get().partitionId(), 0, 0
        for batch in slices(batches):
            found = encoder(path, keeps_blanks).encode(batch.column("text"))
            lengths = np.fromiter((len(ids) + 1 for ids in found), np.int64, len(found))
            ends = np.cumsum(lengths)
            flat = np.empty(int(ends[-1]), np.int32)
            flat[ends - 1] = end_id
            kept = np.ones(len(flat), bool)
            kept[ends - 1] = False
            flat[kept] = np.concatenate(found) if len(found) else []
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), part, np.int32)),
                    pa.array(np.arange(row, row + len(found))),
                    batch.column("id").cast(pa.int64()),
                    pa.array(start + ends - lengths),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                ["part", "row", "doc_id", "start_in_part", "n_tokens", "ids"],
            )
            row, start = row + len(found), start + int(ends[-1])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", keeps_blanks: bool = False, parts: int | None = None) -> None:
    """Write the ids of every whole text, each closed by ``end_id``, in ascending order of the id."""
    parts = parts or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(parts, "id", "tie", "place").sortWithinPartitions("id", "tie", "place").select("id", "text")
    ordered.mapInArrow(_encode(tokenizer, end_id, keeps_blanks), STORED).write.options(**OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with ``start``: the ids of all documents before each one."""
    stored = spark.read.schema(STORED).orc(path)
    sizes = stored.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    begins = _running(sizes)
    return stored.join(F.broadcast(begins), "part").withColumn("start", F.col("begin") + F.col("start_in_part")).drop("begin")


def look_up(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The stored rows of a few documents.

    Files, stripes and row groups whose minima, maxima or Bloom filters rule the ids out are skipped.
    """
    return spark.read.schema(STORED).orc(path).where(F.col("doc_id").isin(list(doc_ids)))


def _running(sizes: DataFrame) -> DataFrame:
    """Where each part begins. One row per file, whose number the writer's ``parts`` sets, so the
    list is small at any input size."""
    begin, rows = 0, []
    for row in sizes.orderBy("part").toLocalIterator():
        rows.append((row["part"], begin))
        begin += row["size"]
    return sizes.sparkSession.createDataFrame(pa.table({"part": pa.array([r[0] for r in rows], pa.int32()), "begin": pa.array([r[1] for r in rows], pa.int64())}))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values, offsets = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids as little-endian 32-bit numbers."""
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
