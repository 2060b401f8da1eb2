"""Queries over the test tables, each with its SQL counterpart."""
