"""Readers for instrument reports and dimension tables, writers for result tables."""
