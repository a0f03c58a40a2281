"""Readers for ledger logs, streams and landed files."""
