"""Incremental (Structured Streaming) variants of the silver/gold steps."""

from .ingest import (landing_stream, events_long_stream, dim_period_stream,  # noqa: F401
                     run_available_now, new_periods_writer)
