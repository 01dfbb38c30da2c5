"""Streaming jobs over message logs."""
