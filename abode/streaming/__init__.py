"""Incremental landing of yearly claim files with Structured Streaming."""
