"""Readers and writers: CSV records, append-only JSON logs, HTML pages, snapshots."""
