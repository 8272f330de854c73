"""Streaming Bronze to Silver with the batch operators, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulselake import schemas
from pulselake.operators.enrich import References
from pulselake.operators.quality import RULES, Rule
from pulselake.plans.runs import judge
from pulselake.sources import tables
from pulselake.streaming.ingest import drain


def append_judged(
    batch: DataFrame, root: str, record_type: str, refs: References,
    rules: Mapping[str, Sequence[Rule]] = RULES, parity: bool = False,
) -> int:
    """Judge a batch and append the rows whose key is in neither zone yet.

    A key that was judged before, as Silver or as quarantine, is a redelivery. Rows without a
    usable key are told apart by their whole content.
    """
    judged = tables.zoned(judge(batch, record_type, refs, rules, parity))
    rows = tables.conform(judged, tables.silver_layout(record_type))
    unusable = F.col("user_id").isNull() | F.col("timestamp").isNull()
    content = F.to_json(F.struct(*[f.name for f in schemas.BRONZE[record_type]]))
    keyed = rows.withColumn(tables.OWN_KEY, F.when(unusable, content))
    return tables.append_new_rows(
        keyed, f"{root}/{record_type}", ("user_id", "timestamp", tables.OWN_KEY), ("zone", "date")
    )


def silver_stream(
    bronze: DataFrame, root: str, record_type: str, refs: References, checkpoint: str,
    rules: Mapping[str, Sequence[Rule]] = RULES, parity: bool = False,
) -> StreamingQuery:
    """Drain a Bronze stream of one type into its Silver and Quarantine zones, by rules as in a batch run."""

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        append_judged(batch, root, record_type, refs, rules, parity)

    return drain(
        bronze.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
