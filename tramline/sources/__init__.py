"""Where tables, topics, feeds and schedule files are read from and written to."""
