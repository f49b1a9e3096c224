"""Micro-batch adapters for the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a row-wise scorer (column expressions only) to a streaming DataFrame."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return scorer(stream)


def apply_per_batch(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], path: str,
                    checkpoint: str, fmt: str = "parquet", trigger_once: bool = False):
    """Run a whole-table operator on every micro-batch and append its output.

    ``checkpoint`` must be a folder in shared storage (the query's progress
    and offsets live there, so a restarted driver resumes where it stopped).
    Returns the started StreamingQuery.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        operator(batch).write.mode("append").format(fmt).save(path)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
