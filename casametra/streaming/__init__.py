"""Structured Streaming form of the incremental silver job."""
