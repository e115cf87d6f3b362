"""Structured Streaming forms of the ingest and the ledger reports."""
