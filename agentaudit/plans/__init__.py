"""Derived inputs, the query catalogue and its SQL twins."""
