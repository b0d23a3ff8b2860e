"""Messages delivered in bounded batches and acknowledged once their batch is done.

The messages lie in files of JSON lines. A reader writes the names of new files, with their number of
lines, behind those it knows, so all messages have one lasting order; an offset is a file's place in
that order and a line. Each batch takes ``maxRows`` messages at most, however many a file holds. When
Spark is done with a batch it commits the batch's end, and that is written down as the
acknowledgement: a query with a new checkpoint starts behind it. A batch that fails is not
acknowledged and comes again. If a job dies after a batch was planned and before Spark wrote that
down, the next batch holds the messages of both, so never more than twice ``maxRows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from coinwharf.sources.notifications import decode_notifications

MAX_ROWS = 1000


def message_source() -> type[DataSource]:
    """The source's class. It is made here so that it goes to the workers whole, which need not have
    this package."""

    class Lines(InputPartition):
        def __init__(self, name: str, start: int, end: int):
            self.name, self.start, self.end = name, start, end

    class Reader(DataSourceStreamReader):
        """Options: ``path`` (files), ``acks`` (a folder for order, plan and acknowledgement), ``maxRows``."""

        def __init__(self, options: dict):
            self.path, self.acks = options["path"], options["acks"]
            self.max_rows = int(options.get("maxRows", 1000))
            self.planned = None

        def _system(self, path: str):
            from pyarrow import fs

            if "://" in path and not path.startswith("file:"):
                return fs.FileSystem.from_uri(path)
            return fs.LocalFileSystem(), path.removeprefix("file://").replace("file:", "", 1)

        def _load(self, name: str, default):
            import json

            system, root = self._system(self.acks)
            try:
                with system.open_input_stream(f"{root}/{name}.json") as file:
                    return json.loads(file.read())
            except FileNotFoundError:
                return default

        def _store(self, name: str, value) -> None:
            import json

            system, root = self._system(self.acks)
            system.create_dir(root, recursive=True)
            with system.open_output_stream(f"{root}/{name}.new") as file:
                file.write(json.dumps(value).encode())
            system.move(f"{root}/{name}.new", f"{root}/{name}.json")

        def _order(self) -> list:
            """(name, lines) of all files, the new ones written behind the known ones."""
            from pyarrow import fs

            order = self._load("order", [])
            system, root = self._system(self.path)
            known = {name for name, _ in order}
            names = [info.base_name for info in system.get_file_info(fs.FileSelector(root)) if info.is_file]
            fresh = sorted(n for n in names if n not in known and not n.startswith((".", "_")))
            for name in fresh:
                lines = 0
                with system.open_input_stream(f"{root}/{name}") as file:
                    last = b""
                    while block := file.read(1 << 20):
                        lines += block.count(b"\n")
                        last = block
                order.append([name, lines + (last[-1:] not in (b"", b"\n"))])
            if fresh:
                self._store("order", order)
            return order

        def initialOffset(self) -> dict:
            return self._load("acknowledged", {"file": 0, "line": 0})

        def latestOffset(self) -> dict:
            place = lambda offset: (offset["file"], offset["line"])
            if self.planned is None:  # a new process goes on behind what was planned
                self.planned = max(self._load("planned", self.initialOffset()), self.initialOffset(), key=place)
            file, line = place(self.planned)
            left, order = self.max_rows, self._order()
            while file < len(order) and left:
                taken = min(left, order[file][1] - line)
                left, line = left - taken, line + taken
                if line == order[file][1]:
                    file, line = file + 1, 0
            planned = {"file": file, "line": line}
            if planned != self.planned:
                # written before Spark knows it, so no offset in a checkpoint is behind it
                self._store("planned", planned)
                self.planned = planned
            return planned

        def partitions(self, start: dict, end: dict) -> list[Lines]:
            order = self._load("order", [])
            parts = []
            for i in range(start["file"], min(end["file"] + 1, len(order))):
                first = start["line"] if i == start["file"] else 0
                last = end["line"] if i == end["file"] else order[i][1]
                if first < last:
                    parts.append(Lines(order[i][0], first, last))
            return parts

        def read(self, partition: Lines):
            import io
            import itertools
            import json

            system, root = self._system(self.path)
            with system.open_input_stream(f"{root}/{partition.name}") as file:
                for line in itertools.islice(io.BufferedReader(file, 1 << 20), partition.start, partition.end):
                    try:
                        data = json.loads(line).get("data")
                    except (ValueError, AttributeError):
                        data = None
                    yield (data if isinstance(data, str) else None,)

        def commit(self, end: dict) -> None:
            self._store("acknowledged", end)

    class Messages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "acknowledged_messages"

        def schema(self) -> str:
            return "data string"

        def streamReader(self, schema) -> Reader:
            return Reader(self.options)

    return Messages


def acknowledged_arrivals(
    spark: SparkSession, folder: str, acks: str, scheme: str = "gs", max_rows: int = MAX_ROWS
) -> DataFrame:
    """New messages of a folder of JSON lines, decoded to object paths; bad messages have none.

    ``acks`` is a folder that outlives the query and that no other reader uses.
    """
    spark.dataSource.register(message_source())
    options = {"path": folder, "acks": acks, "maxRows": str(max_rows)}
    messages = spark.readStream.format("acknowledged_messages").options(**options).load()
    return decode_notifications(messages, scheme=scheme)
