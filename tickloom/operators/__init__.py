"""Relational operators over record, interval and reference tables."""
