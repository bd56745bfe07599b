"""Structured Streaming form of the cursor load."""
