"""Whole runs: daily collection, backfill and review."""
