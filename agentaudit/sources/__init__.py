"""Readers and writers: record table, span files, nested records, exports."""
