"""Structured Streaming jobs and the versioned tables they write."""
