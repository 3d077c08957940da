"""Structured Streaming jobs and their batch twins."""
