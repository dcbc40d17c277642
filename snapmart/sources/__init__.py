"""Readers: landed snapshots, typed CSV, semi-structured columns, calendars."""
