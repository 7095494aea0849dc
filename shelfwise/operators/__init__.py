"""Reusable DataFrame operators: joins, aggregates, conform, data rules."""
