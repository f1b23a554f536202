"""Queries over spans and records. Every function takes and returns DataFrames."""
