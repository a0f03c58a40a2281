"""Structured Streaming jobs that keep the curated tables current."""
