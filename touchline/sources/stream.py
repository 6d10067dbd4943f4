"""Message stream source: a Kafka topic, or a replay of landed broker records from files.

Both yield the same six columns (``key, value, topic, partition, offset, timestamp``),
so the Bronze operators do not know which one feeds them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from touchline.schemas import KAFKA_RECORD


@dataclass(frozen=True)
class StreamSource:
    kind: str = "files"                 # "kafka" or "files"
    topic: str | None = None            # kafka: topic to subscribe to
    servers: str = "localhost:9092"     # kafka: bootstrap servers (an option, never a literal)
    starting_offsets: str = "earliest"  # kafka: data produced before the first start is kept
    max_per_trigger: int | None = None  # rate limit: offsets (kafka) or files per micro-batch
    fail_on_data_loss: bool = True      # kafka: stop if offsets were lost; False skips them
    path: str | None = None             # files: folder of landed records
    file_format: str = "parquet"


def kafka_options(src: StreamSource) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": src.servers,
        "subscribe": src.topic or "",
        "startingOffsets": src.starting_offsets,
        "failOnDataLoss": str(src.fail_on_data_loss).lower(),
    }
    if src.max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(src.max_per_trigger)
    return opts


def record_stream(spark: SparkSession, src: StreamSource) -> DataFrame:
    """A streaming DataFrame of broker records."""
    if src.kind == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(src)).load()
    if src.kind != "files":
        raise ValueError(f"unknown stream source kind {src.kind!r}")
    reader = spark.readStream.schema(KAFKA_RECORD).format(src.file_format)
    if src.max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(src.max_per_trigger))
    return reader.load(src.path)
