"""The queries users call: each takes tables (and options) and returns a frame."""
