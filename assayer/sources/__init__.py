"""Readers: each returns a DataFrame or a configured reader, and runs no job of its own."""
