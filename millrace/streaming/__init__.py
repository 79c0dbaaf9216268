"""Structured Streaming forms of the sources, sinks and stateful operators."""
