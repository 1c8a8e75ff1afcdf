"""Structured Streaming: inputs, event-time operators, result tables and topics."""
