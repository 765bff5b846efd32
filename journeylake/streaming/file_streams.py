"""Structured Streaming over arriving files.

Streams run with ``availableNow``: each start takes every file that arrived since the last
one and stops, which is how a scheduler calls them. The checkpoint remembers the files;
batch folders in the lake make a repeated batch a no-op.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import unseen
from ..sources.files import read_event_csv, read_lead_csv, with_row_numbers
from ..sources.lake import Lake, values_of
from .pipeline import run_leads


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of a checkpoint, so that a new checkpoint never reuses old batch names."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"][:8]


def _per_batch(lake: Lake, checkpoint: str, prefix: str, act) -> callable:
    def handle(df: DataFrame, batch_id: int) -> None:
        rows = with_row_numbers(df) if "_source_file_name" in df.columns else df
        act(rows, f"{prefix}-{_stream_id(lake.spark, checkpoint)}-{batch_id:08d}")

    return handle


def load_files(lake: Lake, stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends each micro-batch of a file stream to one table."""
    handle = _per_batch(lake, checkpoint, "stream", lambda df, batch: lake.append(target, batch, lambda: df))
    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_leads(lake: Lake, folder: str, checkpoint: str, require_consent: bool = False) -> StreamingQuery:
    """Lead files through the whole chain, one `run_leads` per micro-batch."""
    handle = _per_batch(lake, checkpoint, "leads", lambda df, batch: run_leads(lake, df, batch, require_consent))
    return (
        read_lead_csv(lake.spark, folder, streaming=True).writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_entity(lake: Lake, folder: str, entity: str, checkpoint: str, encoding: str = "UTF-16",
                  pattern: str | None = None) -> StreamingQuery:
    """One event entity's files into its raw table."""
    source = read_event_csv(lake.spark, folder, entity, encoding, streaming=True, pattern=pattern)
    return load_files(lake, source, f"raw_events/{entity}", checkpoint)


def load_events_once(
    lake: Lake, stream: DataFrame, target: str, keys: list[str], event_time: str, delay: str, checkpoint: str
) -> StreamingQuery:
    """Each event of a file stream once into ``target``, late ones into ``<target>_late``.

    An event is late when its time lies more than ``delay`` before the newest one of earlier
    batches; late ones are kept beside the table, so that a report that was closed stays as it is
    and nothing is lost. Both tables lie by day, and a repeated event has the time it had before
    (``event_time`` must follow from ``keys``), so a batch is compared with its own days only and
    repeats are found however late they come. Events without a time are on time.
    """
    spark = lake.spark
    day = F.to_date(event_time)

    def old(name: str, rows: DataFrame) -> DataFrame:
        return lake.read(name, values_of(rows, day)) if lake.exists(name) else rows.limit(0)

    def act(df: DataFrame, batch: str) -> None:
        rows = df.dropDuplicates(keys).persist()
        try:
            clock = lake.read_or_none(f"{target}_clock")
            newest = None if clock is None else clock.agg(F.max("newest")).first()[0]
            bound = F.lit(newest) - F.expr(f"interval {delay}")
            is_late = F.lit(False) if newest is None else F.coalesce(F.col(event_time) < bound, F.lit(False))
            fresh = unseen(rows, old(target, rows), keys, narrow=True)
            lake.append(target, batch, lambda: fresh.filter(~is_late), day)
            # The batch itself, written a moment ago, has none of the late events.
            lake.append(f"{target}_late", batch, lambda: unseen(
                fresh.filter(is_late), old(f"{target}_late", rows), keys, narrow=True), day)
            lake.append(f"{target}_clock", batch, lambda: rows.agg(F.max(event_time).alias("newest")))
        finally:
            rows.unpersist()

    return (
        stream.writeStream.foreachBatch(_per_batch(lake, checkpoint, "once", act)).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def without_repeats(events: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drops re-delivered events inside the watermark, for streams that must not write. State
    holds keys for ``delay`` only; Spark also drops new events older than the watermark, which
    `load_events_once` keeps."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)

