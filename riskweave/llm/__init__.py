"""Operators for preparing text corpora at scale (language id, quality, dedup,
scoring, packing, search, token files).  Nothing else in the library imports
this subpackage; its queries are registered by ``__spark_entry__.py``."""
