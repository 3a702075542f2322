"""Readers and writers: driver tables and views, index / segment CSVs, sidecars,
profile and category-index JSON, table sinks."""
