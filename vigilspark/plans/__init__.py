"""Registered queries: every operator bound to the test tables, with its SQL check."""
