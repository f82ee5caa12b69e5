"""Readers. All of them give text columns and, on request, each row's place in its source."""

from tidemark.sources.delimited import read_csv
from tidemark.sources.documents import leaf_fields, read_json, read_xml
from tidemark.sources.tables import newer_than, read_jdbc, read_query, read_table

__all__ = ["leaf_fields", "newer_than", "read_csv", "read_jdbc", "read_json", "read_query", "read_table", "read_xml"]
