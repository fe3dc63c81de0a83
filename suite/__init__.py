"""Registered queries: each operator on the given tables, beside the SQL it must equal."""
