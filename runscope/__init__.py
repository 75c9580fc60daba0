"""Comparison of groups of workflow runs as Spark jobs."""
