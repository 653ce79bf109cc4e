"""End-to-end jobs that write tables."""
