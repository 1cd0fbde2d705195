"""Streaming entry points.

The studied workload reads only bounded files, so no watermark, window or
state operator is owed.  ``score_stream`` applies any fitted batch transform
(a ``pyspark.ml`` model or a DataFrame -> DataFrame function) to each
micro-batch of a ``readStream`` through ``foreachBatch``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame


def score_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None],
                 checkpoint: str, trigger_once: bool = True):
    """Start a query that runs ``transform`` on every micro-batch and hands the result to ``sink``."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, epoch: sink(transform(batch), epoch))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
