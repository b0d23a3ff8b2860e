"""Landed CSV files: the load plan, listing, routing and reading."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from coinwharf.functions.paths import route
from coinwharf.functions.temporal import instant_literal
from coinwharf.operators.kinds import column_kinds, typed
from coinwharf.schemas import RAW_COLUMNS, raw_schema
from coinwharf.session import empty_frame, small_frame

# The parts of the job's configuration document that describe writes.
CONFIG_DDL = (
    "bigquery struct<write_mode_default: string>, tables map<string, struct<write_mode: string>>"
)
DEFAULT_MODE = "append"
LISTING_DDL = "path string, modificationTime timestamp, length long"


def load_plan(spark: SparkSession, config_path: str) -> DataFrame:
    """(table, write_mode) for each table the job's configuration document names."""
    document = spark.read.schema(CONFIG_DDL).option("multiLine", True).json(config_path)
    return document.select(
        F.explode("tables").alias("table", "entry"),
        F.col("bigquery.write_mode_default").alias("default_mode"),
    ).select(
        "table",
        F.coalesce("entry.write_mode", "default_mode", F.lit(DEFAULT_MODE)).alias("write_mode"),
    )


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files directly in a folder whose name fits the pattern (path, modificationTime, length).

    Only the listing is used; the files' contents are never read. A missing or empty
    folder gives no rows.
    """
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, StructType.fromDDL(LISTING_DDL))
    return found.select("path", "modificationTime", "length")


def routed(files: DataFrame) -> DataFrame:
    """The files with the ``table`` each belongs to; NULL marks a file to skip."""
    return files.withColumn("table", route(F.col("path")))


def planned(files: DataFrame, plan: DataFrame) -> DataFrame:
    """Routed files with their table's write mode; tables missing from the plan append.

    The plan has one row per entity, so Spark broadcasts it by its measured size.
    """
    return (
        routed(files)
        .where(F.col("table").isNotNull())
        .join(plan, "table", "left")
        .withColumn("write_mode", F.coalesce("write_mode", F.lit(DEFAULT_MODE)))
    )


def _literal_path(path: str) -> str:
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _bare(path: str) -> str:
    """One spelling for ``/a``, ``file:/a`` and ``file:///a``."""
    return re.sub(r"^file:/+", "/", path)


#: Bytes read for a header line at most.
MAX_HEADER = 1 << 20


def _first_lines(limit: int = MAX_HEADER):
    """Reads files' first lines in tasks. It goes to the workers whole, which need not have this package."""

    def first_line(path: str) -> str | None:
        import re

        import pyarrow as pa
        from pyarrow import fs

        if "://" not in path or path.startswith("file:"):
            with open(re.sub("^file:/+", "/", path), "rb") as file:
                line = file.readline(limit)
        else:
            try:
                system, inner = fs.FileSystem.from_uri(path)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError, OSError):
                return None  # Python knows no way to this file system
            with system.open_input_stream(inner) as file:
                line = b""
                while b"\n" not in line and len(line) < limit and (more := file.read(1 << 16)):
                    line += more
            line = line.split(b"\n", 1)[0]
        return line.decode("utf-8-sig", "replace").rstrip("\r\n")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            lines = [first_line(path) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(lines, pa.string())], ["path", "line"])

    return run


#: Files whose first lines one task reads.
FILES_PER_TASK = 64


def header_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str | None]:
    """Each file's first line, read in tasks, up to its line break only.

    Where Python cannot reach the file system, Spark reads the text of those files to find a line
    that starts at their beginning.
    """
    listed = small_frame(spark, [(path,) for path in paths], "path string")
    # the file names alone are dealt to tasks
    dealt = listed.repartition(min(-(-len(paths) // FILES_PER_TASK), 10_000)) if len(paths) > 1 else listed
    lines = {row["path"]: row["line"] for row in dealt.mapInArrow(_first_lines(), "path string, line string").collect()}
    if unread := [path for path, line in lines.items() if line is None]:
        start = F.col("_metadata.file_block_start") == 0
        rows = spark.read.text([_literal_path(p) for p in unread]).where(start)
        rows = rows.select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
        first = rows.groupBy("file").agg(F.min_by("value", "row").alias("line"))
        found = {_bare(unquote(row["file"])): row["line"] for row in first.collect()}
        lines |= {path: found.get(_bare(path)) for path in unread}
    return lines


def _names(line: str) -> list[str]:
    return [field.strip().strip('"') for field in line.split(",")]


def _other_header(columns: Sequence[str]) -> Column:
    """Whether a row repeats the column names, though not as the header that it was read by."""
    names, values = [F.lit(c) for c in columns], F.array(*[F.trim(F.col(f"`{c}`")) for c in columns])
    any_name = reduce(or_, [F.col(f"`{c}`") == columns[0] for c in columns])
    same_names = F.array_sort(values) == F.array(*[F.lit(c) for c in sorted(columns)])
    return F.coalesce(any_name & same_names & (values != F.array(*names)), F.lit(False))


def read_raw(
    spark: SparkSession,
    paths: Sequence[str],
    entity: str,
    headers: str = "by_name",
    infer: bool = False,
) -> DataFrame:
    """All files of one entity as one DataFrame, every column text.

    ``headers="strict"`` reads them in one scan and fails when a header differs from the
    entity's columns. ``"by_name"`` also takes files whose header has another order: tasks read the
    files' first lines, then each distinct header is one read, matched by name; a file with a header
    line of another order further down fails that read. ``infer=True`` also gives each column the
    narrowest type that leaves every value as it is; it costs one more scan.
    """
    columns = RAW_COLUMNS[entity]
    escaped = [_literal_path(p) for p in paths]
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if headers not in ("strict", "by_name"):
        raise ValueError(f"headers must be 'strict' or 'by_name', not {headers!r}")
    if headers == "strict":
        rows = reader.schema(raw_schema(entity, stamped=False)).csv(escaped)
    else:
        groups: dict[tuple[str, ...], list[str]] = {}
        for path, line in header_lines(spark, paths).items():
            order = tuple(_names(line or ""))
            # files without a usable header go to the strict read, which reports them
            groups.setdefault(order if sorted(order) == sorted(columns) else tuple(columns), []).append(path)
        parts = [
            reader.schema(", ".join(f"`{c}` string" for c in order))
            .csv([_literal_path(p) for p in files])
            .where(F.when(_other_header(order), F.raise_error(F.lit("a file has several different header lines"))).otherwise(True))
            for order, files in groups.items()
        ]
        rows = reduce(DataFrame.unionByName, parts).select(*columns)
    if infer:
        rows = typed(rows, {row["name"]: row["kind"] for row in column_kinds(rows).collect()})
    return rows


def stamped(raw: DataFrame, run_ts=None) -> DataFrame:
    """Add the instant of ingestion."""
    return raw.withColumn("ingestion_timestamp", instant_literal(run_ts))
