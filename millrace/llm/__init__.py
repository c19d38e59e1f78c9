"""Operators for preparing training corpora of any size.

Each operator takes and returns DataFrames. Python runs inside tasks only, on
Arrow batches; executors import this package, so ship it (`--py-files`) where it
is not installed.
"""
