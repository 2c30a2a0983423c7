"""Column-to-column functions; none of them needs a Python worker."""
