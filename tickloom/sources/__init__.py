"""Readers for records, symbology and reference data."""
