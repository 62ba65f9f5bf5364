"""Structured Streaming queries of the order bus."""

from logloom.streaming.bus import (
    file_bus_stream, kafka_bus_stream, kept_bus_stream, land_bus, land_in_order, publish_to_kafka,
    run_to_completion,
)
from logloom.streaming.loopback import loopback_batch, looped_stream, pending_records
from logloom.streaming.offsets import (
    BatchReport, batch_offsets, newest_positions, offset_history_append, read_history,
)
from logloom.streaming.state import KeyedState
from logloom.streaming.unpaid import (
    judge_batch, remind_batch, start_reminder_job, start_unpaid_reminders,
    start_unpaid_reminders_kafka, verdicts,
)

__all__ = [
    "BatchReport", "KeyedState", "batch_offsets", "file_bus_stream", "judge_batch", "kafka_bus_stream",
    "kept_bus_stream", "land_bus", "land_in_order", "loopback_batch", "looped_stream", "newest_positions",
    "offset_history_append", "pending_records", "publish_to_kafka", "read_history", "remind_batch",
    "run_to_completion", "start_reminder_job", "start_unpaid_reminders", "start_unpaid_reminders_kafka",
    "verdicts",
]
