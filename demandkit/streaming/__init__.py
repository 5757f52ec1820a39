"""Structured Streaming forms of the daily series and of the lag features."""
