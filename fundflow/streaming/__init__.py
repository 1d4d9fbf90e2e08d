"""Streaming variant of the yearly-file fund summary (Structured Streaming)."""

from fundflow.streaming.incremental import (  # noqa: F401
    abatement_fund_stream, read_yearly_stream, start_summary, tif_fund_stream,
)
