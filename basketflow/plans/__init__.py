"""Whole jobs: what is read, in which order it is written, and what is reused."""
