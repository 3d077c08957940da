"""Whole jobs: operators put together, with their intermediate and final tables."""
