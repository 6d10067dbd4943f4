"""Structured Streaming runs: Bronze ingest, incremental Silver, keyed de-duplication."""
