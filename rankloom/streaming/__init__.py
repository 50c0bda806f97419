"""Structured Streaming form of the resumable encoding job."""
