"""Experiment runs as an ordinary table."""
