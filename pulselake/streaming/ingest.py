"""Structured Streaming ingest: new landing files or messages into Bronze."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulselake import schemas
from pulselake.functions.codec import MESSAGE, decode_records, opened
from pulselake.functions.texts import date_parts
from pulselake.operators.keys import deduplicate
from pulselake.sources.tables import OWN_KEY, append_new_rows, bronze_partitions, write_bronze

REJECTED = "rejected"
#: Columns added while redelivered messages are dropped; exact times, which JSON would else cut to milliseconds.
ARRIVED, COPY = "__arrived", "__copy"
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, file_format: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Files of a landing folder as a stream with a declared schema."""
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def text_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """One message per line in column ``value``."""
    return file_stream(spark, folder, schemas.layout("value string"), "text", max_files)


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """Messages of a broker topic; needs Spark's Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until an available-now query has read all there is."""
    query.awaitTermination()
    return query


def writer_of(query: StreamingQuery) -> str:
    """The name under which a query writes to Bronze, the same in every run from its checkpoint."""
    return str(query.id)


def append_stream(rows: DataFrame, bronze: str, checkpoint: str) -> StreamingQuery:
    """Append what is new since the last run of this checkpoint to partitioned Bronze, then stop.

    Each micro-batch is a set of partitions named after the query's own id, which its checkpoint keeps,
    and the batch's number. A repeated batch overwrites them: every batch counts once, and any number
    of streams and batch loads share one root. A new checkpoint is another query, also at the same
    path, so a replay never overwrites what was there; ``tables.retire_writer`` takes the replaced
    rows back. The rows of each batch are counted on the writing job; see ``progress``, and
    ``totals`` for those of all runs.
    """
    counted: dict[int, int] = {}
    started = threading.Event()
    writer: list[str] = []

    def on_batch(batch: DataFrame, number: int) -> None:
        started.wait()
        seen = Observation()
        write_bronze(batch.observe(seen, F.count(F.lit(1)).alias("rows")), bronze, writer[0], f"n{number:012d}")
        counted[number] = seen.get["rows"]

    query = (
        rows.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    writer.append(writer_of(query))
    started.set()
    query.counted = counted
    return query


def ingest_files(
    spark: SparkSession, record_type: str, landing: str, bronze: str, checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """One type's landing Parquet files into Bronze by type and date, with two audit columns.

    All types can go to the same root, each with a checkpoint of its own.
    """
    stream = file_stream(spark, landing, schemas.BRONZE[record_type], max_files=max_files)
    audited = stream.withColumns({
        "record_type": F.coalesce("record_type", F.lit(record_type)),
        "_ingested_at": F.current_timestamp(), "_source_file": F.col("_metadata.file_path"),
        **date_parts(F.col("timestamp").try_cast("timestamp")),
    })
    return drain(append_stream(audited, bronze, checkpoint))


def bronze_rows(
    messages: DataFrame, value: str = "value", encoding: str = "base64", envelope: str | None = None
) -> DataFrame:
    """Messages to rows of the multiplexed Bronze table.

    ``envelope`` is the JSON path of the record where messages wrap it: ``$.data`` or
    ``$.kinesis.data`` in the original's brokers. A message without it is poison, kept as it came.

    Good records go under their own type and date. Poison messages become type ``rejected`` with
    their text and reason, so one sink and one pass keep them all. The text is also kept for
    record types without a known layout.
    """
    decoded = decode_records(opened(messages, value, envelope), value, encoding)
    bad = F.col("reject_reason").isNotNull()
    known = F.col("record_type").isin(*schemas.RECORD_TYPES)
    fields = [f.name for f in schemas.stream_schema() if f.name != "record_type"]
    parts = date_parts(F.col("timestamp").try_cast("timestamp"))
    return decoded.select(
        F.when(bad, REJECTED).otherwise(F.col("record_type")).alias("record_type"),
        *[F.when(~bad, F.col(c)).alias(c) for c in fields],
        F.when(bad | ~known, F.coalesce("payload", F.col(MESSAGE) if envelope else F.lit(None))).alias("payload"),
        "reject_reason",
        *[F.when(~bad, c).alias(n) for n, c in parts.items()],
    )


def ingest_messages(
    messages: DataFrame, bronze: str, checkpoint: str, encoding: str = "base64", envelope: str | None = None
) -> StreamingQuery:
    """Decode and demultiplex a message stream into partitioned Bronze, drain and stop."""
    rows = bronze_rows(messages, encoding=encoding, envelope=envelope)
    return drain(append_stream(rows, bronze, checkpoint))


def without_redelivered(stream: DataFrame, within: str) -> DataFrame:
    """The stream without equal rows that arrive again ``within`` this time, such as ``1 hour``, of the first.

    State holds one digest per distinct row and is bounded by what arrives in that time. The watermark
    runs on arrival, not on the rows' own times, so no row is ever too late; a copy that comes after
    its digest has left the state passes, and is for an exact sink to drop.
    """
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), EXACT), 256)
    arriving = stream.withColumns({ARRIVED: F.current_timestamp(), COPY: content})
    return arriving.withWatermark(ARRIVED, within).dropDuplicatesWithinWatermark([COPY]).drop(ARRIVED, COPY)


def append_unique(
    stream: DataFrame, path: str, checkpoint: str,
    keys: Sequence[str] = ("record_type", "user_id", "timestamp"), redelivered: str | None = None,
) -> StreamingQuery:
    """Drain an at-least-once stream into a table that holds each key once.

    A row without a readable time or with a null in its key is told apart by its whole content, so
    only exact copies of it are dropped.

    Copies within a micro-batch are reduced map-side, copies of earlier batches by the idempotent
    append. No copy comes too late and no late row is lost; a batch repeated after a failure adds
    nothing. Nothing is kept in state unless ``redelivered`` names a time: equal rows that arrive again
    within it are then dropped by ``without_redelivered`` and never meet the table. The result is the
    same; a checkpoint keeps the choice it was started with.
    """
    if redelivered is not None:
        stream = without_redelivered(stream, redelivered)

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        day = F.to_date(F.col("timestamp").try_cast("timestamp"))
        unusable = day.isNull()
        for k in keys:
            unusable = unusable | F.col(k).isNull()
        content = F.to_json(F.struct(*batch.columns), EXACT)
        keyed = batch.withColumns({"date": day, OWN_KEY: F.when(unusable, content)})
        append_new_rows(deduplicate(keyed, (*keys, OWN_KEY)), path, (*keys, OWN_KEY))

    return drain(
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def progress(query: StreamingQuery) -> dict[str, int]:
    """Totals of a finished Bronze query: batches with rows, and rows read."""
    counts = [n for n in query.counted.values() if n]
    return {"n_batches": len(counts), "rows_read": sum(counts)}


def totals(spark: SparkSession, bronze: str) -> DataFrame:
    """Batches with rows and rows held per writer, over all its runs, read from Bronze itself."""
    live = spark.createDataFrame(
        [(p, v[4], v[5]) for p, v in bronze_partitions(spark, bronze).items()], "folder string, writer string, batch string"
    )
    held = spark.read.parquet(bronze).select(F.regexp_extract(F.col("_metadata.file_path"), "/(record_type=.*)/[^/]*$", 1).alias("folder"))
    rows = held.groupBy("folder").agg(F.count(F.lit(1)).alias("rows"))
    return live.join(rows, "folder").groupBy("writer").agg(
        F.count_distinct("batch").alias("n_batches"), F.sum("rows").alias("rows_held")
    )
