"""Registered queries: each operator applied to the supplied tables, with SQL."""
