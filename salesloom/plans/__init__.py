"""Sessions, read-only SQL and named questions."""
