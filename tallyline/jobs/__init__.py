"""Command-line jobs."""
