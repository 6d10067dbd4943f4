"""Publish messages: a keyed JSON value per row, to a broker topic or a file sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def message_key(key: str | Column | None = None, id_field: str = "id") -> Column:
    """Per message: the key given, else the object's id, else ``'unknown'`` (as text)."""
    given = F.lit(None) if key is None else F.col(key) if isinstance(key, str) else key
    return F.coalesce(given.cast("string"), F.col(id_field).cast("string"), F.lit("unknown"))


def to_messages(df: DataFrame, topic: str, key: str | Column | None = None,
                id_field: str = "id") -> DataFrame:
    """Rows -> ``(key, value, topic)`` with the whole row as the JSON value."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    return df.select(message_key(key, id_field).alias("key"),
                     F.to_json(payload).alias("value"), F.lit(topic).alias("topic"))


def publish(messages: DataFrame, fmt: str = "kafka", path: str | None = None,
            servers: str | None = None, mode: str = "append") -> None:
    """Write ``(key, value, topic)`` rows to Kafka, or to files (``fmt`` = parquet/json)."""
    if fmt == "kafka":
        (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .save())
        return
    messages.write.format(fmt).mode(mode).save(path)
