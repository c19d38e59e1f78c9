"""Inputs derived from the star-schema tables, the queries over them, and the
SQL that checks the queries."""
