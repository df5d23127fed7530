"""Partitioned tables, text formats and model artefacts."""
