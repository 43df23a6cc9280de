"""Dimension, fact, mart, quality and audit plans: pure DataFrame functions."""
