"""Streams: arriving chunk files deduplicated, windowed counts of late events, rolling chat summaries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loamline.functions.keys import chunk_content_hash


def new_chunks(spark: SparkSession, path: str, watermark: str = "2 days") -> DataFrame:
    """Chunks of arriving files, each content once within the watermark; the state is bounded by it."""
    rows = spark.readStream.schema("id string, text string, arrived timestamp").json(path)
    rows = rows.where((F.trim("id") != "") & (F.trim("text") != "")).withColumn("content_hash", chunk_content_hash("text"))
    return rows.withWatermark("arrived", watermark).dropDuplicatesWithinWatermark(["content_hash"])


def windowed_counts(events: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per key and window, with late ones up to the watermark."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n"))


def rolling_summaries(turns: DataFrame, keep: int = 10, chars: int = 1_200) -> DataFrame:
    """The last turns of each conversation and a summary of those before, updated as turns arrive."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        summary, kept = state.get if state.exists else ("", "")
        lines = [x for x in kept.split("\x1e") if x]
        for b in batches:
            lines += [f"{r}: {' '.join(t.split())}" for r, t in b.sort_values("turn")[["role", "text"]].itertuples(index=False)]
        old, lines = lines[:-keep], lines[-keep:]
        summary = "\n".join([summary, *old] if summary else old)[-chars:]
        state.update((summary, "\x1e".join(lines)))
        yield pd.DataFrame({"conv_id": [key[0]], "summary": [summary], "kept_turns": [len(lines)]})

    return turns.groupBy("conv_id").applyInPandasWithState(
        update, "conv_id long, summary string, kept_turns int", "summary string, kept string", "update", GroupStateTimeout.NoTimeout
    )
