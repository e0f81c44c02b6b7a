"""Operators that prepare text and vectors for model training; nothing else in the package imports this one."""
