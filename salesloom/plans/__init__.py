"""Composed jobs: the whole warehouse and the end-to-end run."""
