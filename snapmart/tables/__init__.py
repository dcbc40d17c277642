"""Writes: layout, table loads, zones, state and run log."""
