"""Topics: connector options, payload decoding, and publishing.

The connector and Avro modules ship as Spark packages of their own; everything
here that needs no running session works, and is tested, without them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import schemas
from changeflow.operators.events import (
    DECODED,
    EMPTY,
    MISSING_FIELD,
    REQUIRED_FIELDS,
    UNDECODABLE,
    UNKNOWN_FRAME,
    UNKNOWN_SCHEMA,
)
from changeflow.settings import ConfigurationError, TopicSettings
from changeflow.sources.directory import append_keyed, read_directory

#: The first byte of a registry frame, and the login module of a mechanism.
MARKER = "00"
_LOGIN_MODULES = {
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
    "SCRAM-SHA-256": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
}


def security_options(settings: TopicSettings) -> dict[str, str]:
    """Connection security, the same for reading and publishing."""
    options = {"kafka.security.protocol": settings.security_protocol}
    if settings.uses_sasl:
        options["kafka.sasl.mechanism"] = settings.sasl_mechanism
        options["kafka.sasl.jaas.config"] = (
            f"{_LOGIN_MODULES[settings.sasl_mechanism.upper()]} required"
            f' username="{_jaas(settings.sasl_username)}"'
            f' password="{_jaas(settings.sasl_password)}";'
        )
    return options


def _jaas(value: str | None) -> str:
    if value is None:
        raise ConfigurationError("SASL needs a user name and a password")
    return value.replace("\\", "\\\\").replace('"', '\\"')


def read_options(settings: TopicSettings, max_offsets: int | None = None) -> dict[str, str]:
    """Source options. Progress lives in the query's checkpoint, never in the broker."""
    options = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic,
        "startingOffsets": settings.starting_offsets,
        **security_options(settings),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def write_options(settings: TopicSettings) -> dict[str, str]:
    """Sink options for the output topic; refuses to run without one."""
    if not settings.output_topic:
        raise ConfigurationError("SINK_OUTPUT_TOPIC must be set to publish")
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "topic": settings.output_topic,
        "kafka.enable.idempotence": "true",
        "kafka.acks": "all",
        **security_options(settings),
    }


def read_topic(
    spark: SparkSession,
    settings: TopicSettings,
    max_offsets: int | None = None,
    progress: str | None = None,
) -> DataFrame:
    """The topic as a stream of ``key, value, kafka_partition, kafka_offset``.

    A topic directory notes in ``progress`` how far it was read.
    """
    if settings.directory:
        stream = read_directory(
            spark, f"{settings.directory}/{settings.topic}", startingOffsets=settings.starting_offsets,
            maxOffsetsPerTrigger=max_offsets, progress=progress,
        )
    else:
        reader = spark.readStream.format("kafka")
        stream = reader.options(**read_options(settings, max_offsets)).load()
    return stream.select(
        F.col("key").cast("string").alias("key"),
        "value",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def split_frame(value: Column) -> list[Column]:
    """Split a registry frame: marker byte, four-byte schema id, body."""
    return [
        F.hex(F.substring(value, 1, 1)).alias("marker"),
        F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint").alias("schema_id"),
        F.substring(value, 6, 2147483647).alias("body"),
    ]


def frame_status(value: Column, known_ids: Sequence[int | None]) -> Column:
    """What is wrong with a registry frame; DECODED where its body may be decoded.

    ``known_ids`` are the schema ids there is a schema for; None among them stands for
    any other id.
    """
    marker, schema_id, _ = split_frame(value)
    named = [i for i in known_ids if i is not None]
    known = F.lit(None in known_ids) | F.coalesce(schema_id.isin(named), F.lit(False))
    return (
        F.when(value.isNull(), EMPTY)
        .when((F.length(value) < 5) | (marker != MARKER), UNKNOWN_FRAME)
        .when(~known, UNKNOWN_SCHEMA)
        .otherwise(DECODED)
    )


def decode_framed(
    topic: DataFrame,
    decoders: Mapping[int | None, Callable[[Column], Column]],
    event: T.StructType = schemas.ORDER_EVENT,
) -> DataFrame:
    """Decode framed values, each by the decoder of its schema id.

    A decoder turns a body into a struct, null where it does not decode. Fields the struct
    lacks are null. Frames without a known marker or schema id are marked and left alone.
    """
    value = F.col("value")
    _, schema_id, body = split_frame(value)
    status = frame_status(value, list(decoders))
    columns = {f"_event_{n}": decode(body) for n, decode in enumerate(decoders.values())}
    decoded = topic.withColumns({**columns, "_status": status, "_schema_id": schema_id})
    read = None
    # the decoder for any other id comes last
    for n, known in sorted(enumerate(decoders), key=lambda x: x[1] is None):
        kind = decoded.schema[f"_event_{n}"].dataType
        row = F.col(f"_event_{n}")
        fields = [
            (row[f.name] if f.name in kind.names else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in event.fields
        ]
        whole = F.when(row.isNotNull(), F.struct(*fields))
        test = F.lit(True) if known is None else F.col("_schema_id") == known
        read = F.when(test, whole) if read is None else read.when(test, whole)
    found = decoded.withColumn("_event", F.when(F.col("_status") == DECODED, read))
    # The operation of a decoded event is never null.
    failed = (F.col("_status") == DECODED) & F.col("_event.op_type").isNull()
    return found.select(
        "_event.*",
        F.when(failed, UNDECODABLE).otherwise(F.col("_status")).alias("decode_status"),
        *_position(topic),
    )


def decode_avro(
    topic: DataFrame,
    schema_ids: Mapping[int | None, str] = {None: schemas.ORDER_EVENT_AVRO},
    event: T.StructType = schemas.ORDER_EVENT,
) -> DataFrame:
    """Decode framed Avro values by the writer schema of each id.

    A value that does not decode is marked, not fatal.
    """
    from pyspark.sql.avro.functions import from_avro

    def decoder(schema: str) -> Callable[[Column], Column]:
        return lambda body: from_avro(body, schema, {"mode": "PERMISSIVE"})

    return decode_framed(topic, {i: decoder(schema) for i, schema in schema_ids.items()}, event)


def decode_json(topic: DataFrame, event: T.StructType = schemas.ORDER_EVENT) -> DataFrame:
    """Decode JSON values against the fixed schema of their events.

    ``decode_status`` tells a payload that does not parse from one that is empty or
    lacks the key of a required field; a key holding null is present.
    """
    text = F.col("value").cast("string")
    parsed = F.from_json(text, event, {"mode": "PERMISSIVE"})
    required = [f for f in REQUIRED_FIELDS if f in event.names]
    keys = F.json_object_keys(text)
    complete = F.forall(
        F.array(*[F.lit(f) for f in required]), lambda f: F.array_contains(keys, f)
    )
    status = (
        F.when(text.isNull() | (F.trim(text).isin("null", "{}")), EMPTY)
        .when(keys.isNull(), UNDECODABLE)
        .when(~complete, MISSING_FIELD)
        .otherwise(DECODED)
    )
    return topic.select(parsed.alias("event"), status.alias("decode_status"), *_position(topic)).select(
        "event.*", "decode_status", *_position(topic)
    )


def _position(topic: DataFrame) -> list[str]:
    return [c for c in schemas.POSITION.names if c in topic.columns]


def framed(body: Column, schema_id: int) -> Column:
    """A body behind the marker and its schema id, as a registry's readers expect it."""
    return F.concat(F.unhex(F.lit(MARKER)), F.unhex(F.lit(f"{schema_id:08X}")), body)


def avro_value(schema: str, schema_id: int) -> Callable[[Column], Column]:
    """Encodes a row as a framed Avro value; to be passed to ``published``."""
    from pyspark.sql.avro.functions import to_avro

    return lambda row: framed(to_avro(row, schema), schema_id)


def json_value(row: Column) -> Column:
    return F.to_json(row, {"ignoreNullFields": "false"})


def published(
    applied: DataFrame,
    key: str | Sequence[str] = "order_id",
    value: Callable[[Column], Column] = json_value,
    gone: Column | None = None,
) -> DataFrame:
    """Applied rows as topic records: the key, and the encoded row.

    A key of several columns is a JSON object. Rows that are ``gone`` have a null value,
    which a compacted topic takes as the end of the key.
    """
    names = [key] if isinstance(key, str) else list(key)
    whole = F.col(names[0]).cast("string") if len(names) == 1 else json_value(F.struct(*names))
    encoded = value(F.struct(*applied.columns))
    if gone is not None:
        encoded = F.when(F.coalesce(~gone, F.lit(True)), encoded)
    return applied.select(whole.alias("key"), encoded.alias("value"))


def publish(applied: DataFrame, settings: TopicSettings, **record) -> None:
    """Write applied rows to the output topic; ``record`` is what ``published`` takes."""
    records, options = published(applied, **record), write_options(settings)
    if settings.directory:
        append_keyed(records, f"{settings.directory}/{settings.output_topic}")
    else:
        records.write.format("kafka").options(**options).save()
