"""Readings from tables, text and message logs."""
