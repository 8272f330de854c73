"""Opening of stream payloads: base64 or plain JSON text, with a reason for every reject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake import schemas

_CORRUPT = "_corrupt_record"
MESSAGE = "_message"


def payload_text(value: Column, encoding: str) -> Column:
    if encoding == "base64":
        return F.try_validate_utf8(F.try_to_binary(value, F.lit("base64")).cast("string"))
    if encoding == "text":
        return value.cast("string")
    raise ValueError(f"unknown payload encoding: {encoding}")


def unwrap_envelope(value: Column, path: str = "$.data") -> Column:
    """The record inside a broker envelope that carries it under the JSON path ``path``."""
    return F.get_json_object(value.cast("string"), path)


def opened(messages: DataFrame, value: str = "value", envelope: str | None = None) -> DataFrame:
    """Messages taken out of their envelope, the whole message kept in ``_message``."""
    if envelope is None:
        return messages
    return messages.withColumns({MESSAGE: F.col(value).cast("string"), value: unwrap_envelope(F.col(value), envelope)})


def decode_records(messages: DataFrame, value: str = "value", encoding: str = "base64") -> DataFrame:
    """Parse each message against the stream schema.

    Adds the record columns, ``payload`` (the text) and ``reject_reason``: ``undecodable``,
    ``invalid_json`` or ``schema_mismatch``, null for a good record. No row is dropped. A record
    without a type gets the type ``unknown``.
    """
    layout = schemas.stream_schema()
    parsed_ddl = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in layout
    ) + f", {_CORRUPT} string"
    opened = messages.withColumn("payload", payload_text(F.col(value), encoding)).drop(value)
    record = F.from_json(
        "payload", parsed_ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    # inlined as one generated row: Spark would otherwise parse anew for every column and filter
    kept = [c for c in opened.columns if c not in layout.names]
    parsed = opened.select(*kept, F.inline(F.array(record)))
    corrupt = F.col(_CORRUPT).isNotNull()
    reason = (
        F.when(F.col("payload").isNull(), "undecodable")
        .when(corrupt & F.json_object_keys("payload").isNull(), "invalid_json")
        .when(corrupt, "schema_mismatch")
    )
    fields = [
        F.coalesce("record_type", F.lit("unknown")).alias("record_type")
        if f.name == "record_type" else F.col(f.name)
        for f in layout
    ]
    return parsed.select(*kept, *fields, reason.alias("reject_reason"))
