"""Declared checks compiled into aggregates."""
