"""End-to-end batch job and the registry of named queries."""
