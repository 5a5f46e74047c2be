"""Row-local column expressions: no shuffle, no Python in the task."""
