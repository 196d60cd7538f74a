"""Payload codecs: JSON, and Avro in the registry wire format.

Avro needs the spark-avro package on the class path. The wire format is a zero byte, a four-byte
schema id, then the Avro body.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro, to_avro

from keyflow import schemas as S

WIRE_PREFIX_BYTES = 5
_CORRUPT = "_corrupt"
_AVRO_NAMES = {"string": "string", "integer": "int", "long": "long"}


def avro_schema(name: str, struct: T.StructType, enums: dict[str, Sequence[str]] | None = None) -> str:
    """Avro record schema of a struct; all fields required, ``enums`` maps field names to symbols."""

    def field_type(field: T.StructField):
        if enums and field.name in enums:
            return {"type": "enum", "name": f"{name}_{field.name}", "symbols": list(enums[field.name])}
        if isinstance(field.dataType, T.StructType):
            return record(f"{name}_{field.name}", field.dataType)
        return _AVRO_NAMES[field.dataType.typeName()]

    def record(record_name: str, inner: T.StructType) -> dict:
        fields = [{"name": field.name, "type": field_type(field)} for field in inner]
        return {"type": "record", "name": record_name, "fields": fields}

    return json.dumps(record(name, struct))


INBOUND_AVRO = avro_schema("Inbound", S.EVENT)
OUTBOUND_AVRO = avro_schema(
    "Outbound", S.PROCESSED_EVENT, {"status": list(S.WIRE_STATUS.values())}
)


def decode_json(value: Column) -> Column:
    """The event, or null for a missing or malformed payload."""
    schema = T.StructType([*S.EVENT.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(value.cast("string"), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    event = F.struct(*[parsed[name].alias(name) for name in S.EVENT.names])
    return F.when(parsed.isNotNull() & parsed[_CORRUPT].isNull(), event)


def decode_avro(value: Column) -> Column:
    framed = (F.substring(value, 1, 1) == F.lit(b"\x00")) & (F.length(value) > WIRE_PREFIX_BYTES)
    body = F.substring(value, WIRE_PREFIX_BYTES + 1, 2**31 - 1)
    return F.when(framed, complete(from_avro(body, INBOUND_AVRO, {"mode": "PERMISSIVE"})))


def complete(event: Column) -> Column:
    """Null for an event of nulls: all fields are required, so that is what a body that cannot be read becomes."""
    return F.when(F.coalesce(*[F.when(event[name].isNotNull(), F.lit(True)) for name in S.EVENT.names]), event)


def encode_json(event: Column) -> Column:
    return F.to_json(event).cast("binary")


def wire_prefix(schema_id: int) -> bytes:
    return b"\x00" + schema_id.to_bytes(4, "big")


def encode_avro(event: Column, schema_id: int) -> Column:
    return F.concat(F.lit(wire_prefix(schema_id)), to_avro(event, OUTBOUND_AVRO))


def decode(value: Column, codec: str = "json") -> Column:
    decoders = {"json": decode_json, "avro": decode_avro}
    return decoders[codec](value)


def encode(event: Column, codec: str = "json", schema_id: int | None = None) -> Column:
    if codec == "json":
        return encode_json(event)
    if codec == "avro" and schema_id is not None:
        return encode_avro(event, schema_id)
    raise ValueError("codec must be json, or avro with a schema id")
