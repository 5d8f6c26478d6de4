"""Operators for large training-text corpora: one module each, with the registered queries in ``queries``."""
