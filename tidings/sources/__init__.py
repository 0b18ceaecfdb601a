"""Readers: delimited records, file folders, catalog tables, news and company feeds."""
