"""Arrival messages: base64 text of a JSON object that names a bucket and an object."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from coinwharf.functions.paths import object_uri

MESSAGE_DDL = "bucket string, name string"


def encode_notifications(objects: DataFrame) -> DataFrame:
    """(bucket, name) rows as message ``data``; the inverse of decoding."""
    body = F.to_json(F.struct("bucket", "name"))
    return objects.select(F.base64(F.encode(body, "UTF-8")).alias("data"))


def decode_notifications(messages: DataFrame, data: str = "data", scheme: str = "gs") -> DataFrame:
    """Add ``bucket``, ``name`` and ``path``; a message that cannot be decoded has no path.

    Bad base64, bad UTF-8, bad JSON and missing fields all end as a NULL path instead of
    failing the batch; :func:`undecodable` returns those rows.
    """
    text = F.try_validate_utf8(F.try_to_binary(F.col(data), F.lit("base64")).cast("string"))
    return (
        messages.withColumn("_body", F.from_json(text, MESSAGE_DDL))
        .withColumn("bucket", F.col("_body.bucket"))
        .withColumn("name", F.col("_body.name"))
        .withColumn("path", object_uri(F.col("bucket"), F.col("name"), scheme))
        .drop("_body")
    )


def undecodable(decoded: DataFrame) -> DataFrame:
    """Messages whose object is unknown, for the audit log."""
    return decoded.where(F.col("path").isNull())
