"""Schemas, scans, sinks and test-table adapters."""
