"""Semesta: a study-results and library-lending warehouse built on PySpark."""
