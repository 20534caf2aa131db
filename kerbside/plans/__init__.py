"""Operators put together: whole refreshes, incremental runs and the query catalogue."""
