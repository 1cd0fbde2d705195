"""Readers and writers (CSV, positional CSV, partitioned run logs, model tables, grid maps)."""
