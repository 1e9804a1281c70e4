"""Typed table reads and writes."""
