"""Spark jobs for sports match statistics: read, conform, join, collapse, score."""
