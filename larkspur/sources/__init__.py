"""Scans: driver tables, topic records, delimited text, partitioned archives."""
