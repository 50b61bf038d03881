"""Structured Streaming scorer and windowed rates."""
