"""Structured Streaming jobs; see :mod:`rampart.streaming.jobs`."""
