"""Sluice: validated file drops, normalized output and run analytics on Spark."""
