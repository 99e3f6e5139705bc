"""Search plans, and whole pipelines."""
