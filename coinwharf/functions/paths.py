"""Object paths: base names, routing and arrival messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Words looked for in a base name, in this order, and the table each one means.
ROUTES = (
    ("account", "account"),
    ("branch", "branch"),
    ("customer", "customer"),
    ("product", "products"),
    ("transaction", "transaction"),
)


def base_name(path: Column) -> Column:
    """The part after the last slash, in lower case."""
    return F.lower(F.substring_index(path, "/", -1))


def route(path: Column) -> Column:
    """The table a file belongs to; NULL when its name holds none of the words."""
    name = base_name(path)
    return F.coalesce(*[F.when(name.contains(word), F.lit(table)) for word, table in ROUTES])


def object_uri(bucket: Column, name: Column, scheme: str = "gs") -> Column:
    """``gs://bucket/name``; NULL when either part is missing."""
    return F.concat(F.lit(f"{scheme}://"), bucket, F.lit("/"), name)
