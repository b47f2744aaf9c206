"""Kafka sink: options and record layout.

The connector comes with the cluster (``spark-sql-kafka``); here are only the
mapping of the settings and the columns it reads.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# Fixed values of the producer.
MAX_MESSAGES = 25_000
BATCH_BYTES = MAX_MESSAGES * 1024
TIME_HEADER = "event_ms"
SECURITY_KEYS = (
    "kind",
    "security_protocol",
    "ssl_ca_location",
    "ssl_key_location",
    "ssl_certificate_location",
    "enable_ssl_certificate_verification",
)


@dataclass(frozen=True)
class KafkaConfig:
    """Settings of the sink; unknown names are rejected.

    ``message_max_size`` left out means the client's own limit. ``group_id`` is
    accepted and has no effect on a producer.
    """

    topic: str
    brokers: str
    group_id: str
    security_config: Mapping[str, object] | None = None
    session_timeout_ms: int = 6000
    message_timeout_ms: int | None = 5000
    message_max_size: int | None = None

    @classmethod
    def of(cls, settings: Mapping[str, object]) -> KafkaConfig:
        known = {field.name for field in fields(cls)}
        unknown = sorted(set(settings) - known)
        if unknown:
            raise ValueError(f"unknown Kafka settings: {unknown}")
        missing = sorted({"topic", "brokers", "group_id"} - set(settings))
        if missing:
            raise ValueError(f"missing Kafka settings: {missing}")
        return cls(**settings)


def kafka_options(config: KafkaConfig | Mapping[str, object]) -> dict[str, str]:
    """Options of Spark's Kafka sink for these settings.

    One acknowledgement, no lingering, no compression by the broker's client (the
    values are packed already). The client resends inside its delivery timeout;
    past it the task fails and Spark runs it again, so delivery is at least once.
    """
    if not isinstance(config, KafkaConfig):
        config = KafkaConfig.of(config)
    options = {
        "topic": config.topic,
        "kafka.bootstrap.servers": config.brokers,
        "kafka.acks": "1",
        "kafka.linger.ms": "0",
        "kafka.batch.size": str(BATCH_BYTES),
        "kafka.compression.type": "none",
        "kafka.max.block.ms": str(config.session_timeout_ms),
    }
    if config.message_timeout_ms is not None:
        timeout = str(config.message_timeout_ms)
        options["kafka.delivery.timeout.ms"] = timeout
        # The client insists on delivery timeout >= request timeout + linger.
        options["kafka.request.timeout.ms"] = timeout
    if config.message_max_size is not None:
        options["kafka.max.request.size"] = str(config.message_max_size)
    if config.security_config is not None:
        options.update(_security_options(config.security_config))
    return options


def _security_options(security: Mapping[str, object]) -> dict[str, str]:
    unknown = sorted(set(security) - set(SECURITY_KEYS))
    if unknown:
        raise ValueError(f"unknown security settings: {unknown}")
    if security.get("kind") != "Ssl":
        raise ValueError("security_config.kind must be 'Ssl'")
    required = SECURITY_KEYS[1:5]
    missing = [name for name in required if name not in security]
    if missing:
        raise ValueError(f"missing security settings: {missing}")
    options = {
        "kafka.security.protocol": str(security["security_protocol"]),
        "kafka.ssl.truststore.type": "PEM",
        "kafka.ssl.truststore.certificates": _pem(security["ssl_ca_location"]),
        "kafka.ssl.keystore.type": "PEM",
        "kafka.ssl.keystore.key": _pem(security["ssl_key_location"]),
        "kafka.ssl.keystore.certificate.chain": _pem(security["ssl_certificate_location"]),
    }
    # The JVM client can only leave out the check of the host name.
    if security.get("enable_ssl_certificate_verification") is False:
        options["kafka.ssl.endpoint.identification.algorithm"] = ""
    return options


def _pem(location: object) -> str:
    return Path(str(location)).read_text()


def kafka_columns(records: DataFrame) -> DataFrame:
    """``key, value, partition, headers`` as Spark's Kafka sink reads them.

    The sink has no column for the record time, so it travels in a header.
    """
    time = F.struct(
        F.lit(TIME_HEADER).alias("key"),
        F.encode(F.col("event_ms").cast("string"), "utf-8").alias("value"),
    )
    return records.select("key", "value", "partition", F.array(time).alias("headers"))


def kafka(
    records: DataFrame,
    config: KafkaConfig | Mapping[str, object],
    checkpoint: str | None = None,
) -> DataFrameWriter | DataStreamWriter:
    """Writer for the records; call ``save()`` on a batch, ``start()`` on a stream."""
    options = kafka_options(config)
    rows = kafka_columns(records)
    if not records.isStreaming:
        return rows.write.format("kafka").options(**options)
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = rows.writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint)
