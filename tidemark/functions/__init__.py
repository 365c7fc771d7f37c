"""Column expressions. Each takes and returns a ``Column``; none triggers a job."""
