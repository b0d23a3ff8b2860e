"""Parquet tables that can be appended to, replaced and upserted.

Spark refuses to overwrite a table it is reading, and a dynamic partition overwrite
leaves the old copy of a row whose partition changed. So each change writes new files
under ``data/v=<n>-<id>``, a folder no other writer uses, and then one small ``log/v=<n>``
that says which folders joined the table and which folders or files left it. The log entry is
written aside and renamed into place, which fails if another writer has committed that version:
then this one's files are deleted and ``ConcurrentWrite`` is raised. Readers see the table before
the change or after it, and a job that dies on the way leaves nothing they would read. Every COMPACT commits the log so far
is also written to ``snapshot/v=<n>``; readers take the newest one and the few log entries after
it, so the files they open stay few however long a table lives. ``expire`` deletes the files that left the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from coinwharf.operators.interleave import BOUNDS_DDL, bounds_of, interleaved
from coinwharf.operators.upsert import INSERT, UPDATE, apply_updates, check_unique, images, merge_upsert, merged_images, outranks
from coinwharf.session import BROADCAST_ROWS, empty_frame, join_side, small_frame, staged

#: ``location`` is a folder, or a file that left its folder; a commit's own row has none, and names
#: the folder of its row changes: empty where no row changed, NULL where they were not kept.
LOG_DDL = "location string, day string, rows long, removed boolean, load_id string, changes string"
#: Commits after which the log is written as one; load ids kept with a state that was read.
COMPACT, RECENT_LOADS = 50, 10_000
#: A table of at most so many times the source's rows is merged whole: few of its files hold no match.
NEAR_ROWS = 4


#: The newest state read of each table; a version never changes once it is committed.
_STATES: dict[str, State] = {}


class ConcurrentWrite(RuntimeError):
    """Another writer committed the version this one was about to."""


@dataclass(frozen=True)
class State:
    """What the log says: the newest version, the folders in use, and whether a load is in it."""

    version: int
    live: list[Row]
    seen: bool
    last_load: str | None = None
    recent: frozenset[str] = frozenset()
    commits: int = 0

    @property
    def locations(self) -> list[str]:
        return [entry["location"] for entry in self.live]

    @property
    def rows(self) -> int:
        return sum(entry["rows"] for entry in self.live)


def _places(folders: Sequence[Row], files_of: Callable[[Row], list[str]] | None = None) -> list[str]:
    """Paths to read: a version's root where all its folders are wanted, else each folder, or the
    files that are left of one that lost some."""
    versions: dict[str, list[Row]] = {}
    for folder in folders:
        versions.setdefault(folder["location"].split("/")[0], []).append(folder)
    places = []
    for version, wanted in versions.items():
        if len(wanted) == wanted[0]["siblings"] and not any(folder["gone"] for folder in wanted):
            places.append(version)
            continue
        for folder in wanted:
            places += files_of(folder) if folder["gone"] else [folder["location"]]
    return places


def _file(metadata: Column) -> Column:
    """A file's place under the table's data folder; no pattern, as it is taken row by row."""
    return F.concat(F.lit("v="), F.substring_index(metadata, "/data/v=", -1))


class SnapshotTable:
    """A parquet table with an optional day partition.

    ``partition`` is (partition column, column it is derived from); the two may be the
    same. ``cluster`` columns sort the rows inside each file, so that their min/max
    statistics let readers skip row groups; several are interleaved bit by bit, so that a filter
    on any one of them skips some. ``gather`` brings each day's rows together
    before they are written; without it rows are written where they are, unshuffled.
    ``hidden`` columns are stored with the others but not among the table's rows; where a write
    lacks them they are NULL. ``options`` go to the Parquet writer.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType | None = None,
        partition: tuple[str, str] | None = None,
        cluster: Sequence[str] = (),
        gather: bool = True,
        hidden: StructType | None = None,
        options: dict[str, str] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self._declared = schema is not None
        self.partition = partition
        self.cluster = list(cluster)
        self.gather = gather
        self.hidden = hidden or StructType()
        self.options = options or {}

    # -- reading ---------------------------------------------------------------

    def state(self, load_id: str | None = None) -> State:
        """What the log says as of now, and whether it holds a load.

        The log is read when it has a version this process has not read; else a listing is enough.
        """
        newest = max(self._versions("log"), default=0)
        state = _STATES.get(self.root)
        if state is None or state.version != newest:
            state = _STATES[self.root] = self._state()
        seen = load_id in state.recent
        if load_id and not seen and state.commits > RECENT_LOADS:
            seen = not self._entries().where(F.col("location").isNull() & (F.col("load_id") == load_id)).isEmpty()
        return replace(state, seen=seen)

    def _state(self) -> State:
        """Read the log: one row per folder, plus one for the commits themselves."""
        entries = self._entries()
        if entries is None:
            return State(0, [], False)
        commit = F.when(F.col("location").isNull(), F.struct("v", "load_id"))
        is_file = F.col("location").endswith(".parquet")
        folder = F.when(is_file, F.regexp_replace("location", "/[^/]+$", "")).otherwise(F.col("location"))
        folders = (
            entries.groupBy(folder.alias("location"), "day")
            .agg(
                (F.coalesce(F.max(F.when(~is_file, F.col("rows"))), F.max("rows")) - F.coalesce(F.sum(F.when(is_file, F.col("rows"))), F.lit(0))).alias("rows"),
                F.bool_or(F.col("removed") & F.coalesce(~is_file, F.lit(True))).alias("removed"),
                F.collect_set(F.when(is_file, F.col("location"))).alias("gone"),
                F.max("v").alias("v"),
                F.max("load_id").alias("load_id"),
                F.max_by("load_id", "v").alias("last_load"),
                F.slice(F.sort_array(F.collect_list(commit), asc=False), 1, RECENT_LOADS).alias("recent"),
                F.count(commit).alias("commits"),
            )
            .withColumn("siblings", F.count("*").over(Window.partitionBy(F.substring_index("location", "/", 1))))
            .where("not removed")
            .collect()
        )
        commits = [row for row in folders if row["location"] is None]
        return State(
            version=commits[0]["v"] if commits else 0,
            live=[row for row in folders if row["location"] is not None],
            seen=False,
            last_load=commits[0]["last_load"] if commits else None,
            recent=frozenset(row["load_id"] for row in commits[0]["recent"] if row["load_id"]) if commits else frozenset(),
            commits=commits[0]["commits"] if commits else 0,
        )

    def _hadoop(self, *parts: str):
        """The file system of the table and a path under its root."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _versions(self, kind: str) -> list[int]:
        """Numbers of the complete ``v=<n>`` folders of a kind; names only are listed."""
        files, path = self._hadoop(kind)
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        found = sorted(int(name[2:]) for name in names if name.startswith("v="))
        # only the newest can be incomplete: a version is begun after the one before it is done
        while found and not files.exists(self._hadoop(kind, f"v={found[-1]}", "_SUCCESS")[1]):
            found.pop()
        return found

    def _entries(self) -> DataFrame | None:
        """The log: the newest snapshot and the entries after it."""
        schema = StructType.fromDDL(LOG_DDL).add("v", IntegerType())
        start = max(self._versions("snapshot"), default=0)
        paths = [f"{self.root}/log/v={n}" for n in self._versions("log") if n > start]
        parts = []
        if start:
            parts.append(self.spark.read.schema(schema).parquet(f"{self.root}/snapshot/v={start}"))
        if paths:
            parts.append(self.spark.read.schema(schema).option("basePath", f"{self.root}/log").parquet(*paths))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def _compact(self, version: int) -> None:
        """Write the log up to a version as one: each commit, and all folders of the versions
        that are still in use (a version is read by its root only if none of its folders left)."""
        entries = self._entries()
        commits = entries.where("location is null")
        folders = entries.where("location is not null").withColumn("of", F.substring_index("location", "/", 1))
        gone = folders.where("removed and location not like '%.parquet'").select("location")
        live = folders.join(gone, "location", "left_anti").where("not removed")
        kept = folders.join(live.select("of").distinct(), "of", "left_semi").select(*commits.columns)
        commits.unionByName(kept).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/snapshot/v={version}")

    def expire(self) -> int:
        """Delete the files of folders that left the table; returns the number of folders.

        Readers that hold an older state lose their files, so call it when there are none. What
        an unfinished write of the next version left is deleted as well.
        """
        folders = self.state().live
        live = {place for folder in folders for place in (folder["location"], folder["location"].split("/")[0])}
        files, data = self._hadoop("data")
        deleted = 0
        for version in files.listStatus(data) if files.exists(data) else ():
            name = version.getPath().getName()
            if name not in live:
                deleted += files.delete(version.getPath(), True)
                continue
            for folder in files.listStatus(version.getPath()) if self.partition else ():
                inner = folder.getPath().getName()
                if folder.isDirectory() and "=" in inner and f"{name}/{inner}" not in live:
                    deleted += files.delete(folder.getPath(), True)
        for gone in (file for folder in folders for file in folder["gone"]):
            files.delete(self._hadoop("data", gone)[1], False)
        return deleted

    def changes_since(self, version: int, until: int) -> DataFrame | None:
        """The row changes of the commits after a version: images of rows before (``sign`` -1) and
        after (1). None where a commit did not keep them."""
        commits = self._entries().where(F.col("location").isNull() & (F.col("v") > version) & (F.col("v") <= until)).select("changes").collect()
        if len(commits) != until - version or any(row["changes"] is None for row in commits):
            return None
        paths = [f"{self.root}/changes/{row['changes']}" for row in commits if row["changes"]]
        return self.spark.read.parquet(*paths) if paths else None if not commits else self.spark.range(0).select()

    def read(self, state: State | None = None) -> DataFrame:
        """The table's rows as of now, or as of a state read before."""
        return self._read((state or self.state()).live)

    def rows_of(self, load_id: str) -> DataFrame:
        """The rows one load appended or put in place, as far as they are still there."""
        return self._read([entry for entry in self.state().live if entry["load_id"] == load_id])

    def rows_loaded(self, load_id: str) -> int:
        """Number of those rows, from the log alone."""
        return sum(entry["rows"] for entry in self.state().live if entry["load_id"] == load_id)

    def row_count(self) -> int:
        """Rows in the table, from the log alone."""
        return self.state().rows

    def _read(self, folders: Sequence[Row], partition: bool = False, extra: Sequence[str] = ()) -> DataFrame:
        """The rows of some folders, where wanted with the partition, hidden columns and ``_file``."""
        schema = self._stored_schema(folders)
        columns = [*self.schema.names, *extra]
        if partition and self.partition and self.partition[0] not in columns:
            columns = [*columns, self.partition[0]]
        if not folders:
            return empty_frame(self.spark, schema).select(*columns)
        places = _places(folders, self._files_left)
        return self._read_places(places, schema).select(*columns, *([_file(F.col("_metadata.file_path")).alias("_file")] if partition else []))

    def _read_places(self, places: Sequence[str], schema: StructType) -> DataFrame:
        reader = self.spark.read.option("basePath", f"{self.root}/data").schema(schema)
        return reader.parquet(*[f"{self.root}/data/{place}" for place in places])

    def _files_left(self, folder: Row) -> list[str]:
        files, path = self._hadoop("data", folder["location"])
        names = [f"{folder['location']}/{status.getPath().getName()}" for status in files.listStatus(path)]
        return [name for name in names if name.endswith(".parquet") and name not in folder["gone"]]

    def _stored_schema(self, folders: Sequence[Row] = ()) -> StructType:
        """The table's columns, hidden ones, and those that stand in folder names."""
        if self.schema is None:
            if not folders:
                raise ValueError(f"{self.root} holds no table and no schema was given")
            self.schema = self.spark.read.parquet(f"{self.root}/data/{folders[0]['location']}").schema
        fields = [*self.schema, *self.hidden]
        if self.partition and self.partition[0] not in self.schema.names:
            fields.append(StructField(self.partition[0], DateType()))
        return StructType([*fields, StructField("v", StringType())])

    # -- writing ---------------------------------------------------------------

    def ensure(self) -> None:
        """Commit an empty first version when there is no table yet."""
        state = self.state()
        if not state.version:
            self._commit(state, None, [], None, changes="")

    def append(self, df: DataFrame, load_id: str | None = None) -> int:
        """Add rows and return their number. A load id that was committed before adds none."""
        state = self.state(load_id)
        if state.seen:
            return 0
        return self._commit(state, df, [], load_id)

    def replace(self, df: DataFrame, load_id: str | None = None) -> int:
        """Put ``df`` in place of all rows and return their number; ``df`` may read this very table."""
        if not self._declared:
            self.schema = df.schema
        state = self.state()
        return self._commit(state, df, state.live, load_id)

    def save(self, df: DataFrame, mode: str, load_id: str | None = None) -> int:
        """Write with one of Spark's save modes; returns the number of rows written."""
        if mode == "append":
            return self.append(df, load_id)
        if mode == "overwrite":
            return self.replace(df, load_id)
        if mode not in ("ignore", "error", "errorifexists"):
            raise ValueError(f"unknown write mode {mode!r}")
        if not self.state().version:
            return self.append(df, load_id)
        if mode == "ignore":
            return 0
        raise ValueError(f"table {self.root} already exists")

    def merge(
        self,
        source: DataFrame,
        keys: Sequence[str],
        on_match: Sequence[str],
        load_id: str | None = None,
        strict: bool = False,
        newest: Sequence[str] = (),
        tie: Sequence[str] = (),
        changes: Sequence[str] = (),
    ) -> dict[str, int]:
        """Upsert ``source`` (unique keys) and return the count of each action.

        1. The source is written once to the shared folder.
        2. A scan of the target's key, partition and ``newest`` columns alone finds the matched rows
           and the files that hold them. A small source is broadcast, so the target is not shuffled.
        3. Only files that hold a match are read whole and written anew; a row whose
           partition changed moves with them. Inserts are added as new files, so a batch
           of new keys rewrites nothing.

        Of many source rows without ``newest`` each match wins: one join, written once, settles rows,
        files and images; step 2 is left out unless the target is far larger than the source.

        With ``newest`` a matched row is updated only if the source's row comes after it: by the
        greatest of these columns in turn, NULL least, then by the least of the ``tie`` columns.
        ``changes`` names columns whose values before and after the merge are kept.
        """
        state = self.state(load_id)
        if state.seen:
            return {}
        stored = [*self.schema.names, *self.hidden.names]
        source = source.select(*[c if c in source.columns else F.lit(None).cast(self.hidden[c].dataType).alias(c) for c in stored])
        if strict or state.live or len(self.cluster) > 1:
            source = staged(source, "source")
        if strict:
            check_unique(source, keys)
        if not state.live:
            return {"keep": 0, "update": 0, "insert": self._commit(state, source, [], load_id)}

        on_match = [*on_match, *self.hidden.names]
        keys, day = list(keys), F.col(self.partition[0]).cast("string") if self.partition else F.lit(None).cast("string")
        target = self._read(state.live, partition=True, extra=[c for c in newest if c in self.hidden.names])
        asked_rows = source.count()  # from the staged files' footers
        asked = source.select(*keys, *[F.col(c).alias(f"s_{c}") for c in newest])
        verdict = outranks(newest) if newest else F.lit(1)
        met = target.join(join_side(asked, asked_rows), keys)
        hits = met.select(*keys, day.alias("_day"), "_file", verdict.alias("_verdict"))
        all_win = not newest and asked_rows > BROADCAST_ROWS
        if all_win:
            whole = self._read(state.live, partition=True, extra=self.hidden.names).select(*stored, "_file")
            if state.rows > NEAR_ROWS * asked_rows:
                places = [unquote(row["_file"]) for row in hits.select("_file").distinct().collect()]
                some = self._read_places(places, self._stored_schema()) if places else None
                whole = some.select(*stored, _file(F.col("_metadata.file_path")).alias("_file")) if places else whole.limit(0)
            merged = staged(merge_upsert(whole, source, keys, on_match, changes), "merged")
            per_file = merged.where(F.col("action") == UPDATE).groupBy("_file").agg(F.count("*").alias("newer")).collect()
        else:
            hits = staged(hits, "hits")
            newer, tied = (F.count_if(F.col("_verdict") == n) for n in (1, 0))
            per_file = hits.groupBy("_day", "_file").agg(newer.alias("newer"), tied.alias("tied"), F.count("*").alias("met")).collect()
            met_rows = sum(row["met"] for row in per_file)
            won = hits.where("_verdict = 1")
            if tie and any(row["tied"] for row in per_file):
                places = [unquote(row["_file"]) for row in per_file if row["tied"]]
                even = join_side(hits.where("_verdict = 0"), sum(row["tied"] for row in per_file))
                tied = self._read_places(places, self._stored_schema()).select(*keys, *tie).join(even, keys)
                tied = tied.join(join_side(source.select(*keys, *[F.col(c).alias(f"s_{c}") for c in tie]), asked_rows), keys)
                before = F.struct(*[F.col(f"s_{c}").alias(c) for c in tie]) < F.struct(*tie)
                won = staged(won.unionByName(tied.where(before).select(*hits.columns)), "won")
                per_file = won.groupBy("_day", "_file").agg(F.count("*").alias("newer")).collect()
        touched = {unquote(row["_file"]): row["newer"] for row in per_file if row["newer"]}
        updates = sum(touched.values())

        kept_images = None
        if all_win:
            # rows of files without a match stay where they are
            rewritten = F.col("_file").isin([row["_file"] for row in per_file]) | (F.col("action") == INSERT)
            changed = merged.where(rewritten).select(*stored)
            if changes:
                kept_images = merged_images(merged, changes)
        else:
            fresh = source.join(join_side(hits.select(*keys), met_rows), keys, "left_anti").select(*stored)
            changed = fresh
            if changes:
                kept_images = fresh.select(*changes, F.lit(1).alias("sign"))
            if touched:
                files = self._read_places(list(touched), self._stored_schema()).select(*stored)
                winners = join_side(source.join(join_side(won.select(*keys), updates), keys, "left_semi"), updates)
                changed = apply_updates(files, winners, keys, on_match).unionByName(fresh)
                if changes:
                    kept_images = images(files, winners, keys, on_match, changes).unionByName(kept_images)
        # a folder that loses all its files leaves the table, others lose files
        gone = self._rows_by_file(list(touched)) if touched else {}
        by_folder: dict[str, list[tuple[str, int]]] = {}
        for file, rows in gone.items():
            by_folder.setdefault(file.rsplit("/", 1)[0], []).append((file, rows))
        folders, files = [], []
        for entry in state.live:
            inside = [(file, entry["day"], rows) for file, rows in by_folder.get(entry["location"], ())]
            if inside and sum(n for _, _, n in inside) == entry["rows"]:
                folders.append(entry)
            else:
                files += inside
        written = self._commit(state, changed, folders, load_id, files, kept_images)
        inserts = written - sum(gone.values())
        return {"keep": state.rows - updates, "update": updates, "insert": inserts}

    def _rows_by_file(self, places: Sequence[str]) -> dict[str, int]:
        """Rows of some files, from their footers."""
        counts = self._read_places(places, self._stored_schema()).groupBy(F.col("_metadata.file_path").alias("file")).count().select(_file(F.col("file")).alias("file"), "count")
        return {unquote(row["file"]): row["count"] for row in counts.collect()}

    def _clustered(self, df: DataFrame, order: list[str], found: Sequence[tuple[str, int, str]]) -> DataFrame:
        """Rows sorted inside each file; several cluster columns are interleaved."""
        day = order[: len(order) - len(self.cluster)]
        if len(self.cluster) < 2:
            return df.sortWithinPartitions(*order)
        bounds: dict[str, list[str]] = {c: [] for c in self.cluster}
        for name, _, bound in found:
            bounds[name].append(bound)
        placed = df.withColumn("_place", interleaved(bounds))
        return placed.sortWithinPartitions(*day, "_place", *self.cluster).drop("_place")

    def _bounds(self, df: DataFrame) -> list[tuple[str, int, str]]:
        """Where the values of the cluster columns are cut into ranks; settled by the first rows written."""
        path = f"{self.root}/cluster"
        files, done = self._hadoop("cluster", "_SUCCESS")
        if files.exists(done):
            return [tuple(row) for row in self.spark.read.schema(BOUNDS_DDL).parquet(path).orderBy("name", "rank").collect()]
        found = bounds_of(df, self.cluster)
        small_frame(self.spark, found, BOUNDS_DDL).coalesce(1).write.mode("overwrite").parquet(path)
        return found

    def _write(self, df: DataFrame, name: str) -> list[Row]:
        """Write rows under ``data/<name>`` and describe the folders made.

        The rebalance hint gathers each day's rows into few files, and adaptive execution
        splits a day that holds far more rows than the others over several tasks.
        """
        if self.schema is None:
            self.schema = df.schema
        df = df.select(*self.schema.names, *[c if c in df.columns else F.lit(None).cast(self.hidden[c].dataType).alias(c) for c in self.hidden.names])
        path = f"{self.root}/data/{name}"
        day, origin = self.partition or (None, None)
        if day and day != origin:
            df = df.withColumn(day, F.to_date(origin))
        order = [c for c in (day, *self.cluster) if c]
        if self.gather and order:
            bounds = self._bounds(df) if len(self.cluster) > 1 else []
            df = self._clustered(df.hint("rebalance", *([day] if day else [])), order, bounds)
        if not day:
            df.write.options(**self.options).parquet(path)
            rows = self.spark.read.schema(self.schema).parquet(path).count()
            return [Row(location=name, day=None, rows=rows)]

        df.write.options(**self.options).partitionBy(day).parquet(path)
        stored = self.spark.read.schema(self._stored_schema()).parquet(path)
        counts = stored.groupBy(day).count().select(F.col(day).cast("string").alias("day"), "count").collect()
        return [
            Row(
                location=f"{name}/{day}={row['day'] or '__HIVE_DEFAULT_PARTITION__'}",
                day=row["day"],
                rows=row["count"],
            )
            for row in counts
        ]

    def _commit(
        self,
        state: State,
        df: DataFrame | None,
        removed: Sequence[Row],
        load_id: str | None,
        removed_files: Sequence[tuple[str, str | None, int]] = (),
        kept_images: DataFrame | None = None,
        changes: str | None = None,
    ) -> int:
        """Write rows, then the log entry that puts them in place; returns the rows written."""
        version = state.version + 1
        name = f"v={version}-{uuid.uuid4().hex[:12]}"
        if version in self._versions("log"):
            raise ConcurrentWrite(f"version {version} of {self.root} is there already")
        added = [] if df is None else self._write(df, name)
        if kept_images is not None:
            kept_images.write.parquet(f"{self.root}/changes/{name}")
            changes = name
        rows = [(None, None, 0, False, load_id, changes)]
        rows += [(e["location"], e["day"], e["rows"], False, load_id, None) for e in added]
        rows += [(e["location"], e["day"], e["rows"], True, None, None) for e in removed]
        rows += [(location, day, n, True, None, None) for location, day, n in removed_files]
        aside = f"log/.{name}"
        small_frame(self.spark, rows, LOG_DDL).coalesce(1).write.parquet(f"{self.root}/{aside}")
        if not self._renamed(aside, f"log/v={version}"):
            for lost in (aside, f"data/{name}", f"changes/{name}"):
                files, path = self._hadoop(lost)
                files.delete(path, True)
            raise ConcurrentWrite(f"version {version} of {self.root} is there already")
        _STATES[self.root] = self._after(state, version, added, removed, removed_files, load_id)
        if version % COMPACT == 0:
            self._compact(version)
        return sum(entry["rows"] for entry in added)

    @staticmethod
    def _after(
        state: State, version: int, added: Sequence[Row], removed: Sequence[Row], removed_files: Sequence[tuple], load_id: str | None
    ) -> State:
        """The state a commit of this process leads to, as reading the log would give it."""
        left = {entry["location"] for entry in removed}
        by_folder: dict[str, list[tuple[str, int]]] = {}
        for file, _, rows in removed_files:
            by_folder.setdefault(file.rsplit("/", 1)[0], []).append((file, rows))
        live = []
        for entry in state.live:
            gone = by_folder.get(entry["location"], [])
            if entry["location"] not in left:
                changed = {"gone": [*entry["gone"], *(f for f, _ in gone)], "rows": entry["rows"] - sum(n for _, n in gone)}
                live.append(Row(**(entry.asDict() | changed)) if gone else entry)
        live += [Row(**entry.asDict(), gone=[], siblings=len(added), load_id=load_id, v=version) for entry in added]
        recent = state.recent | {load_id} if load_id else state.recent
        return State(version, live, False, load_id, recent, state.commits + 1)

    def _renamed(self, old: str, new: str) -> bool:
        """Rename a folder; False where the new name is taken. Atomic where the file system renames
        folders in one step and refuses to do so onto another, as HDFS does."""
        fs = self.spark._jvm.org.apache.hadoop.fs
        _, source = self._hadoop(old)
        _, target = self._hadoop(new)
        context = fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(source, target, none)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True


def ensure_tables(tables: Sequence[SnapshotTable]) -> None:
    """Create each table that does not exist yet."""
    for table in tables:
        table.ensure()
