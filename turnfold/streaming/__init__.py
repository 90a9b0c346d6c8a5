"""Streaming form of the row-local fold and scoring."""
