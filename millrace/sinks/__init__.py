"""Table writers: append, insert-or-ignore, upsert, refresh, CSV."""
