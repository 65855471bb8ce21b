"""Spark jobs for a release-versioned classification of protein domains."""
