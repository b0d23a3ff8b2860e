"""Structured Streaming: files as they arrive, and the chain each arrival starts."""
