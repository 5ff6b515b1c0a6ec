"""Column factories: pure expressions, no jobs and no state."""
