"""Structured Streaming forms of intake, rates, scoring and alerts."""
