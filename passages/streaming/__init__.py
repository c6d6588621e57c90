"""Structured Streaming forms of the operators that also run on live input."""
