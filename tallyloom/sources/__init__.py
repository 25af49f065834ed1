"""Table, CSV and scratch-folder access."""
