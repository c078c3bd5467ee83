"""Incremental landing of raw files into bronze tables (Structured Streaming)."""
