"""Structured Streaming: publishing, landing and deduplicating order messages."""

from .clean import clean_and_stamp, dedupe_stream
from .kafka import kafka_source_options, publish, read_topic
from .land import land, land_counted, land_observed, landed_batches, landed_file_metrics, observed_batches

__all__ = [
    "clean_and_stamp",
    "dedupe_stream",
    "kafka_source_options",
    "land",
    "land_counted",
    "land_observed",
    "landed_batches",
    "landed_file_metrics",
    "observed_batches",
    "publish",
    "read_topic",
]
