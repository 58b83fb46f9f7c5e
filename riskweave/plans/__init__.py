"""Composition: layers of one input folder, per-job functions, the medallion
batch, the query registry and its DuckDB oracle."""
