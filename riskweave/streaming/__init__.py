"""Structured Streaming use of the stateless layers."""

from riskweave.streaming.incremental import (
    enriched_stream,
    file_stream,
    run_aggregate_to_table,
    run_aggregate_to_versions,
    run_to_completion,
    silver_claims_stream,
    trends_stream,
)

__all__ = ["enriched_stream", "file_stream", "run_aggregate_to_table", "run_aggregate_to_versions", "run_to_completion", "silver_claims_stream",
           "trends_stream"]
