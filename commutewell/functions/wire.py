"""Framed topic messages: one magic byte, a four-byte schema id, then the payload."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER_BYTES = 5  # fixed value of the wire format

_AVRO_TYPES = {
    T.IntegerType: "int",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.StringType: "string",
    T.BooleanType: "boolean",
}


def payload(value: Column) -> Column:
    """Message bytes after the header; empty when there are none, NULL for a NULL message."""
    return F.substring(value, HEADER_BYTES + 1, 2**31 - 1)


def schema_id(value: Column) -> Column:
    """Id of the schema the message was written with: four unsigned bytes, NULL for a shorter message."""
    header = F.substring(value, 2, 4)
    return F.when(F.octet_length(header) == 4, F.conv(F.hex(header), 16, 10).cast("bigint"))


def avro_schema(record: T.StructType, name: str = "record") -> str:
    """Avro schema of a flat record; nullable fields are unions with a NULL default."""
    fields = []
    for f in record.fields:
        kind = _AVRO_TYPES[type(f.dataType)]
        fields.append({"name": f.name, "type": ["null", kind], "default": None} if f.nullable else {"name": f.name, "type": kind})
    return json.dumps({"type": "record", "name": name, "fields": fields})


def from_json_payload(record: T.StructType):
    """Codec: JSON text; what does not parse is a NULL record."""
    return lambda content: F.from_json(content.cast("string"), record)


def from_avro_payload(schema: str):
    """Codec: Avro binary by the JSON ``schema``.

    Needs Spark's Avro module on the class path (``--packages org.apache.spark:spark-avro_2.13:4.1.2``),
    without which Spark refuses the plan. A record that does not parse is NULL.
    """
    from pyspark.sql.avro.functions import from_avro

    return lambda content: from_avro(content, schema, {"mode": "PERMISSIVE"})


def decode(messages: DataFrame, codec, keep: list[str] | None = None, only_schema: int | None = None) -> DataFrame:
    """Records of a topic frame, flat: one row per message, all NULL for an undecodable one.

    ``keep`` names envelope columns to carry along. ``only_schema`` limits the result to messages
    written with that schema id. Works the same on bounded and unbounded frames.
    """
    if only_schema is not None:
        messages = messages.where(schema_id(F.col("value")) == only_schema)
    record = codec(payload(F.col("value"))).alias("data")
    return messages.select(*(keep or []), record).select(*(keep or []), "data.*")
