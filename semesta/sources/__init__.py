"""Readers for the operational tables."""
