"""Readers and writers: base tables, text grids, scratch tables, the published table."""
