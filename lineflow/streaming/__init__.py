"""Flows as named Structured Streaming queries."""

from lineflow.streaming.runner import FlowAlreadyRunning, active_query, start_flow, stop_flow

__all__ = ["FlowAlreadyRunning", "active_query", "start_flow", "stop_flow"]
