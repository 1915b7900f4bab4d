"""Readers, dataset schemas and writers."""

from tidemark.sources.readers import read_delimited, read_table
from tidemark.sources.writers import write_delimited, write_lines, write_table

__all__ = ["read_delimited", "read_table", "write_delimited", "write_lines", "write_table"]
