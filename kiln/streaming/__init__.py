"""Structured Streaming: incremental staging of landed raw files and per-batch findings."""

from .incremental import (monitor_events, raw_stream, stage_landed_files, staged_stream,  # noqa: F401
                          start_incremental)
