"""Event, table and CSV readers."""
