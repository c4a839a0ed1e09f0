"""Streaming: mergeable partial results, or final results behind a watermark."""

from talktally.streaming.final import final_metric, start_final
from talktally.streaming.lag import LagListener, batch_lag
from talktally.streaming.partial import BatchJob, start_partial

__all__ = [
    "BatchJob",
    "LagListener",
    "batch_lag",
    "final_metric",
    "start_final",
    "start_partial",
]
